"""Lines that many documents share, by a sharded minimal perfect hash.

1. Count. Every task hashes the lines of its documents and counts, for each distinct line, the documents that
   have it. What leaves a task is a packed array per shard, so a line that all documents share is one entry per task.
2. Index. A shard's task adds the counts up and builds a minimal perfect hash over the shard's distinct line
   hashes, with an array of 32-bit fingerprints and an array of counts, each as narrow as its largest value.
   Shards are sized by the input, so one fits into a task whatever the size of the corpus.
3. Probe. Documents send their distinct line hashes, packed per task and shard, to the shard's arrays. No line is
   joined to a line; back come only the hashes found to be frequent, per distinct text.
4. Drop. These lines are taken out of the texts.

Lines are told apart by 128-bit hashes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import SPACE, bounded_batches, text_bytes
from brisa.llm.perfect_hash import PerfectHash, fingerprint, keys_of
from brisa.session import as_written_table

MIN_DOCUMENTS = 10
SHARD_BYTES = 32 * 1024 * 1024  # of input for one shard
# Entries that a task gathers before it sends them on.
HELD_LINES = 200_000

STRIP = SPACE.encode()
INDEX = "shard int, n long, hash binary, fingerprints binary, counts binary, width int"


def line_keys(text: bytes) -> list[bytes]:
    """Lines without white space at both ends, A-Z in lower case; one for each line."""
    return [line.strip(STRIP) for line in text.lower().split(b"\n")]


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def shard_count(docs: DataFrame) -> int:
    """By the planner's estimate of the input; at least four per shuffle partition, to spread the shards."""
    least = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 10**16 else 0  # a plan without statistics reports an absurd size
    return max(least, known // SHARD_BYTES)


def _by_shard(digests: list[bytes], shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the digests of each shard."""
    hi, _ = keys_of(digests)
    shard = (hi % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    found, starts = np.unique(shard[order], return_index=True)
    for s, at in zip(found.tolist(), np.split(order, starts[1:]), strict=True):
        yield s, at


def _send(table: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(table, schema=schema)


def build_index(docs: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash of its distinct line hashes, fingerprints and document counts."""
    schema = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            digests, counts = list(held), np.array(list(held.values()), dtype="<u4")
            out: dict[str, list] = {"shard": [], "keys": [], "counts": []}
            for s, at in _by_shard(digests, shards):
                out["shard"].append(s)
                out["keys"].append(b"".join([digests[i] for i in at]))
                out["counts"].append(counts[at].tobytes())
            held.clear()
            return _send(out, schema)

        for batch in batches:
            for text in batch.column(0):
                held.update({digest(k) for k in set(line_keys(text.as_py())) if k})
                if len(held) > HELD_LINES:
                    yield flush()
        if held:
            yield flush()

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(rows["keys"]), dtype="<u8").reshape(-1, 2)
        counts = np.frombuffer(b"".join(rows["counts"]), dtype="<u4").astype(np.int64)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        keys, counts = keys[first], np.add.reduceat(counts, first)
        hi, lo = np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1])
        index = PerfectHash.build(hi, lo)
        place = index.lookup(hi, lo)
        prints = np.empty(len(hi), dtype="<u4")
        prints[place] = fingerprint(hi, lo)
        kind = np.min_scalar_type(int(counts.max()))
        numbers = np.empty(len(hi), dtype=kind)
        numbers[place] = counts
        return pd.DataFrame({
            "shard": [rows["shard"].iloc[0]], "n": [len(hi)], "hash": [index.to_bytes()],
            "fingerprints": [prints.tobytes()], "counts": [numbers.tobytes()], "width": [kind.itemsize],
        })

    counted = docs.select(text_bytes().alias("text")).mapInArrow(count, "shard int, keys binary, counts binary")
    return counted.groupBy("shard").applyInPandas(build, INDEX)


def counts_of(index: pd.Series, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Documents of each line hash by a shard's arrays; 0 for a line that the index does not hold."""
    place = PerfectHash.from_bytes(index["hash"]).lookup(hi, lo)
    prints = np.frombuffer(index["fingerprints"], dtype="<u4")
    numbers = np.frombuffer(index["counts"], dtype=f"<u{int(index['width'])}")
    known = place >= 0
    known[known] = prints[place[known]] == fingerprint(hi, lo)[known]
    out = np.zeros(len(hi), dtype=np.int64)
    out[known] = numbers[place[known]]
    return out


def frequent_lines(docs: DataFrame, index: DataFrame, shards: int, min_documents: int) -> DataFrame:
    """``text_key`` of every text with a frequent line, and the packed hashes of these lines."""
    schema = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()), ("texts", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = defaultdict(list)
        texts: dict[bytes, int] = {}
        n = 0

        def flush() -> pa.RecordBatch:
            digests = list(held)
            names = list(texts)
            out: dict[str, list] = {"shard": [], "keys": [], "owners": [], "texts": []}
            for s, at in _by_shard(digests, shards):
                chosen = [digests[i] for i in at]
                owners = [held[d] for d in chosen]
                # one entry for each line of each text: the key's position, then the text's
                key_at = np.repeat(np.arange(len(chosen), dtype="<u4"), [len(o) for o in owners])
                text_at = np.array([t for o in owners for t in o], dtype="<u4")
                used, text_at = np.unique(text_at, return_inverse=True)
                out["shard"].append(s)
                out["keys"].append(b"".join(chosen))
                out["owners"].append(np.stack([key_at, text_at.astype("<u4")], axis=1).astype("<u4").tobytes())
                out["texts"].append(b"".join([names[i] for i in used]))
            held.clear()
            texts.clear()
            return _send(out, schema)

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                name = name.as_py()
                if name in texts:  # a copy
                    continue
                texts[name] = len(texts)
                lines = {digest(k) for k in set(line_keys(text.as_py())) if k}
                for d in lines:
                    held[d].append(texts[name])
                n += len(lines)
                if n > HELD_LINES:
                    n = 0
                    yield flush()
        if held:
            yield flush()

    def answer(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        names, lines = [], []
        if len(found):
            arrays = found.iloc[0]
            for keys, owners, texts in zip(asked["keys"], asked["owners"], asked["texts"], strict=True):
                pairs = np.frombuffer(keys, dtype="<u8").reshape(-1, 2)
                hi, lo = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
                frequent = counts_of(arrays, hi, lo) >= min_documents
                own = np.frombuffer(owners, dtype="<u4").reshape(-1, 2)
                hits: dict[int, list[bytes]] = defaultdict(list)
                for k, t in own[frequent[own[:, 0]]].tolist():
                    hits[t].append(keys[16 * k : 16 * k + 16])
                names.extend(texts[16 * t : 16 * t + 16] for t in hits)
                lines.extend(b"".join(h) for h in hits.values())
        return pd.DataFrame({"text_key": names, "lines": lines})

    asked = docs.select(text_key().alias("text_key"), text_bytes().alias("text")).mapInArrow(
        ask, "shard int, keys binary, owners binary, texts binary"
    )
    answers = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(answer, "text_key binary, lines binary")
    # at most one row per shard and task that saw the text, each with lines of its own shard
    return answers.groupBy("text_key").agg(F.collect_set("lines").alias("lines"))


def text_key():
    return F.unhex(F.md5(text_bytes()))


def drop_frequent(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Every row without the lines that at least ``min_documents`` rows have.

    Reads ``doc_id`` and ``text``; returns doc_id, n_lines (before dropping), n_dropped and text (the lines
    that stay, joined by a line feed). Null or empty text is one empty line. Lines without a
    visible character have an empty key, which is never frequent. A line that a text repeats counts once for
    it and loses all its copies; repeated rows count as documents of their own.
    """
    bounded_batches(docs.sparkSession)
    shards = shard_count(docs)
    index = as_written_table(build_index(docs, shards), "line-index")
    marks = frequent_lines(docs, index, shards, min_documents)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, dropped, texts = [], [], []
            for text, marked in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not marked:
                    n.append(text.count(b"\n") + 1)
                    dropped.append(0)
                    texts.append(text)
                    continue
                gone = {block[i : i + 16] for block in marked for i in range(0, len(block), 16)}
                lines = text.split(b"\n")
                kept = [line for line, key in zip(lines, line_keys(text), strict=True) if not key or digest(key) not in gone]
                n.append(len(lines))
                dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.binary())],
                ["doc_id", "n_lines", "n_dropped", "kept"],
            )

    rows = docs.select("doc_id", text_bytes().alias("text"), text_key().alias("text_key"))
    joined = rows.join(marks, "text_key", "left").select("doc_id", "text", "lines")
    done = joined.mapInArrow(drop, f"doc_id {kind}, n_lines long, n_dropped long, kept binary")
    return done.select("doc_id", "n_lines", "n_dropped", F.col("kept").cast("string").alias("text"))
