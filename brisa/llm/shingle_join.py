"""Jaccard join of word shingles by universe partitioning.

Two sets whose Jaccard similarity is at least 4/5 differ in at most H = (s + t) / 9 shingles, s and t being their
sizes. All shingles are dealt to m segments by their hash. Sets are taken in bands of size; a band fixes H and m,
and a set takes part in its own band and in the lower bands that hold sets similar to it. H differences touch
at most H segments, so m - H segments of two similar sets agree. With m = H + 1 + x at least x + 1 agree, and a set
may leave out up to x of its segments: the empty ones, and those whose content is frequent.

1. The content of each segment of each set is a signature (a sum of hashes). Sets that share one are candidates. Small
   groups give all their pairs, sixteen sets at most; of a frequent signature every set is a candidate of one set only,
   the one that has most frequent signatures.
2. Candidates are verified on the words of their texts, first one partner for each set, then those that are in different
   components. Now a frequent signature whose sets are all in one component is settled.
3. A set that has left out more than x segments, by what is empty and what is still open, allocates the rest at
   the least cost: some of its other segments may differ in one shingle, which counts twice. These sets index
   their segments and all one-deletion neighbours of them, and probe with the segments that were chosen.
   A set that finds too few such segments is compared within its open signatures with the others in the same
   position, as far as they are in other components.
4. Links become components.

Texts with the same words in the same order are one set from the start. Links join different texts; the
number of copies of a text costs nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import as_derived_table, bounded_batches, released, text_bytes
from brisa.llm.components import components
from brisa.llm.perfect_hash import mix
from brisa.session import as_written_table

WORDS = 5
# Similar: 100 * shared >= 80 * all of both. So the larger set has at most 5/4 of the smaller one's size, and
# both differ in a ninth of the sum of their sizes at most.
PERCENT = 80

SMALL_GROUP = 16
SPARE = 0.04  # part of the segments that a set should be able to leave out as frequent
BLOCK = 1 << 20  # bytes of a text that are split into words at once
HELD_ENTRIES = 1_000_000
BUCKET_BYTES = 4 * 1024 * 1024  # of input for one bucket of signatures
VERIFIED_AT_ONCE = 64  # candidates of one set that meet it together
PAIRS_PER_TASK = 2000

U64 = np.uint64
ID_BITS = U64(0xFFFFFFFFFFFF)
STEP = U64(0x9E3779B97F4A7C15)
FULL, DELETED = U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)


# --- sets ---------------------------------------------------------------------


FACTOR = 0xD6E8FEB86659FD93
BLANK = frozenset(b" \t\n\x0b\x0c\r")
LONG_WORD = 64  # bytes; longer words are hashed each time
HELD_WORDS = 100_000


class WordHashes(dict):
    """Eight bytes of a cryptographic digest of each word, which no two words are made to share with ease."""

    def __missing__(self, word: bytes) -> bytes:
        h = blake2b(word, digest_size=8).digest()
        if len(word) <= LONG_WORD:
            if len(self) >= HELD_WORDS:
                self.clear()
            self[word] = h
        return h


_hash_of = WordHashes()


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in lower case, some at a time: blocks end behind a blank."""
    text = text.lower()
    at = 0
    while at < len(text):
        end = min(at + BLOCK, len(text))
        while end < len(text) and text[end - 1] not in BLANK:
            end += 1
        yield text[at:end].split()
        at = end


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of each word, in order."""
    parts = [np.zeros(0, dtype=np.uint64)]
    for words in word_blocks(text):
        if words:
            parts.append(np.frombuffer(b"".join(map(_hash_of.__getitem__, words)), dtype="<u8"))
    return np.concatenate(parts) if len(parts) > 2 else parts[-1]


def identity(text: bytes) -> bytes | None:
    """The text's identity: 128 bits of a cryptographic digest of its words in order; None without words.

    No word is hashed for it by itself, so it is cheap against ``word_hashes``.
    """
    some, whole = False, blake2b(digest_size=16)
    for words in word_blocks(text):
        if words:
            some = True
            whole.update(b" ".join(words))
            whole.update(b" ")
    return whole.digest() if some else None


def shingles(w: np.ndarray) -> np.ndarray:
    """Different shingles of the words as hashes, in order; a text of fewer words is one shingle."""
    if not len(w):
        return w
    n, width = max(1, len(w) - WORDS + 1), min(WORDS, len(w))
    with np.errstate(over="ignore"):
        h = w[:n] + U64(width)
        for j in range(1, width):
            h *= U64(FACTOR)
            h += w[j : j + n]
    h = mix(h)
    h.sort()
    new = np.empty(n, dtype=bool)
    new[0] = True
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h if new.all() else h[new]


def short(node: bytes) -> int:
    """47 bits that stand for a node among signatures; candidates are looked up by them and told apart by the node."""
    return int.from_bytes(node[:6], "little") >> 1


def halves(node: bytes) -> tuple[int, int]:
    return int.from_bytes(node[:8], "big", signed=True), int.from_bytes(node[8:], "big", signed=True)


def node_of(high: str, low: str) -> Column:
    """The node with these halves."""
    return F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (high, low)]))


# --- bands and segments ---------------------------------------------------------


@cache
def band_starts(size: int) -> tuple[int, ...]:
    """First sizes of the bands, up to the band of ``size`` and one more."""
    starts = [1]
    while starts[-1] <= size:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 5 // 4)))
    return tuple(starts)


@cache
def band(first: int) -> tuple[int, int, int]:
    """Largest size, largest difference of a pair whose smaller set is in the band, segments."""
    starts = band_starts(first)
    last = starts[bisect_right(starts, first)] - 1
    most = (last + last * 5 // 4) // 9
    # as few segments as leave, in all but a few of a thousand sets, more than enough that are not empty
    for m in range(most + 1, 3 * last + 3):
        empty = m * (1 - 1 / m) ** first
        if most == 0 or m - empty - 3 * np.sqrt(empty * (1 - empty / m)) - SPARE * m >= most + 1:
            break
    return last, most, m


@cache
def _top(size: int) -> int:
    return 1 << max(4, size.bit_length())


@cache
def bands_of(size: int) -> tuple[int, ...]:
    """First sizes of the bands that a set takes part in: those with sets of 4/5 of its size up to its own size."""
    starts = band_starts(_top(size))
    low = -(-size * 4 // 5)
    return tuple(s for i, s in enumerate(starts[:-1]) if s <= size and starts[i + 1] - 1 >= low)


def most_apart(size: int, first: int) -> int:
    """Largest difference of a set of this size from any set that it is similar to, in a band that it takes part in."""
    last = band(first)[0]
    return (size + (size * 5 // 4 if size <= last else last)) // 9


def segments(h: np.ndarray, terms: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the segments that are not empty, where each begins in the ordered hashes, and the sum of its terms."""
    m = band(first)[2]
    k = ((h >> U64(32)) * U64(m)) >> U64(32)
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[starts], starts, np.add.reduceat(terms, starts)


def terms_of(h: np.ndarray) -> np.ndarray:
    """What each shingle adds to its segment's signature."""
    return mix(h ^ STEP)


def signature(k: np.ndarray, sums: np.ndarray, first: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(sums + STEP * (k + U64(first << 24)))


# --- packed entries ----------------------------------------------------------------


def six(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def bucket_count(docs: DataFrame) -> int:
    """Buckets of signatures by the planner's estimate of the input, at least four per shuffle partition."""
    least = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, size // BUCKET_BYTES if size < 10**16 else 0)


class Packer:
    """Entries of a signature and a payload of fixed width, gathered and sent as one row for each bucket."""

    schema = pa.schema([("bucket", pa.int32()), ("signatures", pa.binary()), ("ids", pa.binary())])
    columns = "bucket int, signatures binary, ids binary"

    def __init__(self, buckets: int):
        self.buckets, self.held, self.n = buckets, [], 0

    def add(self, signatures: np.ndarray, payload: bytes) -> None:
        """The same payload for all signatures of a set."""
        self.held.append((signatures, payload))
        self.n += len(signatures)

    def flush(self) -> pa.RecordBatch:
        sig = np.concatenate([s for s, _ in self.held])
        payload = np.repeat(
            np.frombuffer(b"".join(p for _, p in self.held), dtype=np.uint8).reshape(len(self.held), -1),
            [len(s) for s, _ in self.held], axis=0,
        )
        self.held, self.n = [], 0
        # the bucket comes from the bits that the packed signature does not have
        bucket = ((sig >> U64(32)) % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        found, starts = np.unique(bucket[order], return_index=True)
        rest, payload = (sig & ID_BITS)[order], payload[order]
        ends = np.r_[starts[1:], len(sig)]
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()),
             pa.array([six(rest[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary()),
             pa.array([payload[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())],
            schema=self.schema,
        )


def id_bytes(me: int) -> bytes:
    return me.to_bytes(6, "little")


def grouped(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different entries of a bucket in order of signature, and where each signature begins; its single ones are dropped."""
    sig = from_six(b"".join(rows["signatures"]))
    ids = from_six(b"".join(rows["ids"]))
    order = np.argsort(sig)
    sig, ids = sig[order], ids[order]
    same = sig[1:] == sig[:-1]
    more = np.r_[False, same] | np.r_[same, False]
    sig, ids = sig[more], ids[more]
    order = np.lexsort((ids, sig))
    sig, ids = sig[order], ids[order]
    if len(sig):
        new = np.r_[True, (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])]
        sig, ids = sig[new], ids[new]
        same = sig[1:] == sig[:-1]
        more = np.r_[False, same] | np.r_[same, False]
        sig, ids = sig[more], ids[more]
    starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, dtype=np.int64)
    return sig, ids, starts


def pairs_of(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the groups, which have at most SMALL_GROUP sets each."""
    a, b = [], []
    for n in np.unique(sizes):
        at = starts[sizes == n]
        for i in range(n - 1):
            for j in range(i + 1, n):
                a.append(ids[at + i])
                b.append(ids[at + j])
    none = np.zeros(0, dtype="<u8")
    return np.concatenate([none, *a]), np.concatenate([none, *b])


# --- the join ------------------------------------------------------------------------


def sets(docs: DataFrame) -> DataFrame:
    """doc_id, node (null for a text without words) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            nodes = [identity(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary())], ["doc_id", "node"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, f"doc_id {kind}, node binary")


def signatures(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed signatures of all bands of all sets. Buckets below 0 hold facts about sets, six numbers for each:
    id, size, segments in its own band that are not empty, how many of its segments it can leave out in any band, and the
    two halves of its node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, seen, facts = Packer(buckets), set(), []

        def flush() -> Iterator[pa.RecordBatch]:
            seen.clear()
            if facts:
                yield packer.flush()
                table = np.array(facts, dtype="<i8")
                facts.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1 - int(table[0, 0]) % buckets], pa.int32()), pa.array([b""], pa.binary()), pa.array([table.tobytes()], pa.binary())],
                    schema=Packer.schema,
                )

        for batch in released(batches):
            for text in batch.column(0):
                data = text.as_py()
                node = identity(data)
                if node is None or node in seen:
                    continue
                seen.add(node)
                me, h = short(node), shingles(word_hashes(data))
                terms = terms_of(h)
                spare = []
                for first in bands_of(len(h)):
                    k, _, sums = segments(h, terms, first)
                    packer.add(signature(k, sums, first), id_bytes(me))
                    spare.append(len(k) - most_apart(len(h), first) - 1)
                facts.append((me, len(h), len(k), min(spare), *halves(node)))  # the own band is the last one
                if packer.n > HELD_ENTRIES:
                    yield from flush()
        yield from flush()

    return docs.select(text_bytes().alias("text")).mapInArrow(run, Packer.columns)


PAIR, OPEN, FACT = 0, 1, 2
CANDIDATES = "kind int, a long, b long, n long, spare long, high long, low long"


def candidates(entries: DataFrame) -> DataFrame:
    """kind, a, b, n, spare, high, low: a PAIR of two sets and the signatures they share in this bucket; OPEN for each set b of a
    frequent signature a; FACT for a set a, its size b, its segments n, the segments it can spare and its node's halves."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] < 0:
            facts = np.frombuffer(b"".join(rows["ids"]), dtype="<i8").reshape(-1, 6)
            return pd.DataFrame({"kind": np.int32(FACT), **{c: facts[:, i] for i, c in enumerate(("a", "b", "n", "spare", "high", "low"))}})
        sig, ids, starts = grouped(rows)
        sizes = np.diff(np.r_[starts, len(sig)])
        small = sizes <= SMALL_GROUP
        a, b = pairs_of(ids, starts[small], sizes[small])
        large = np.repeat(~small, sizes)
        big_sig, big_ids = sig[large], ids[large]
        pair = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1).astype(np.int64)
        pair, n = np.unique(pair, axis=0, return_counts=True) if len(pair) else (pair, np.zeros(0, dtype=np.int64))
        named = name(big_sig, np.full(len(big_sig), rows["bucket"].iloc[0], dtype=np.uint64)).astype(np.int64)
        return pd.DataFrame({
            "kind": np.repeat(np.array([PAIR, OPEN], dtype=np.int32), [len(pair), len(big_ids)]),
            "a": np.concatenate([pair[:, 0], named]), "b": np.concatenate([pair[:, 1], big_ids.astype(np.int64)]),
            "n": np.concatenate([n, np.ones(len(big_ids), dtype=np.int64)]), "spare": np.int64(0), "high": np.int64(0), "low": np.int64(0),
        })

    return entries.groupBy("bucket").applyInPandas(run, CANDIDATES)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, node, text of the sets with these ids, each once; the text is compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in released(batches):
            found: dict[bytes, bytes] = {}
            for text in batch.column(0):
                data = text.as_py()
                node = identity(data)
                if node is not None and node not in seen:
                    seen.add(node)
                    found[node] = squeeze.compress(data)
            if len(seen) > HELD_ENTRIES:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([short(n) for n in found], pa.int64()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())],
                ["id", "node", "packed"],
            )

    rows = docs.select(text_bytes().alias("text")).mapInArrow(run, "id long, node binary, packed binary")
    return rows.join(ids, "id", "left_semi").dropDuplicates(["id", "node"])


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: nodes of the pairs (columns a, b: ids, written) that are similar.

    A set meets its candidates in parts of bounded size, so that a set with many of them is many tasks' work. Each
    text is asked for by all parts that need it in one join. Hashes only rule pairs out: those that they leave are
    compared by their words.
    """
    tasks = max(4 * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs.count() // PAIRS_PER_TASK)
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / VERIFIED_AT_ONCE).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), "parts").cast("int")
    other = pairs.join(many, "a").select(F.col("b").alias("id"), "a", part.alias("part"), F.lit(False).alias("hub"))
    own = many.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("hub"))
    asked = own.union(other).withColumn("task", F.pmod(F.xxhash64("a", "part"), F.lit(tasks)).cast("int"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        open_up = zstandard.ZstdDecompressor()
        left, right = [], []
        rows = rows.sort_values(["a", "part", "hub"], ascending=False)
        at, mine = None, []
        for r in rows.itertuples():
            if at != (r.a, r.part):
                at, mine = (r.a, r.part), []
            text = open_up.decompress(r.packed)
            h = shingles(word_hashes(text))
            if r.hub:
                mine.append((r.node, h, r.packed))
                continue
            for node, hub, packed in mine:
                if node != r.node and similar(hub, h) and similar(*numbered_shingles(open_up.decompress(packed), text)):
                    left.append(node)
                    right.append(r.node)
        return pd.DataFrame({"a": left, "b": right})

    return asked.join(texts, "id").groupBy("task").applyInPandas(compare, "a binary, b binary")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared)


def numbered_shingles(x: bytes, y: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of two texts as numbers that are equal where all their words are, without any hash.

    Texts that differ and have a single shingle of fewer words share nothing.
    """
    numbers: dict[bytes, int] = {}
    w = [np.array([numbers.setdefault(v, len(numbers)) for words in word_blocks(t) for v in words], dtype=np.int64) for t in (x, y)]
    if min(len(w[0]), len(w[1])) < WORDS:
        return np.array([0]), np.array([1])
    n = [len(v) - WORDS + 1 for v in w]
    found = np.concatenate([v[:k] for v, k in zip(w, n, strict=True)])
    for j in range(1, WORDS):
        # the number of a run of j words and the next word give the number of the longer run
        found = found * len(numbers) + np.concatenate([v[j : j + k] for v, k in zip(w, n, strict=True)])
        found = np.unique(found, return_inverse=True)[1]
    return np.unique(found[: n[0]]), np.unique(found[n[0] :])


def lone_shingles(texts: DataFrame, buckets: int) -> DataFrame:
    """id, lone: the shingles of each text that no other of these texts has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, open_up = Packer(buckets), zstandard.ZstdDecompressor()
        for batch in released(batches):
            for me, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packer.add(shingles(word_hashes(open_up.decompress(packed))), id_bytes(me))
                if packer.n > HELD_ENTRIES:
                    yield packer.flush()
        if packer.n:
            yield packer.flush()

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        sig, ids = from_six(b"".join(rows["signatures"])), from_six(b"".join(rows["ids"]))
        order = np.argsort(sig)
        sig, ids = sig[order], ids[order]
        same = sig[1:] == sig[:-1]
        found, n = np.unique(ids[~(np.r_[False, same] | np.r_[same, False])], return_counts=True)
        return pd.DataFrame({"id": found.astype(np.int64), "lone": n})

    packed = texts.select("id", "packed").mapInArrow(send, Packer.columns)
    return packed.groupBy("bucket").applyInPandas(count, "id long, lone long").groupBy("id").agg(F.sum("lone").alias("lone"))


SKETCH_BITS = 1024
SECOND = np.dtype([("id", "<i8"), ("root", "<i8"), ("size", "<i4"), ("common", "<i4"), ("light", "<i4"), ("sketch", "<u8", SKETCH_BITS // 64)])
PROBE, INDEX = 1, 0


def parities(h: np.ndarray) -> np.ndarray:
    """One bit for each class of shingles, whether their number is odd.

    Two sets differ in at least as many shingles as bits, whatever their sizes. The bound is close up to some
    500 shingles and says little beyond 2000; it never excludes a similar pair.
    """
    odd = np.bincount((h & U64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<u8")


class RecordPacker:
    """Entries of a signature, a set's record and a role, sent as one row for each bucket that holds each record once."""

    schema = pa.schema([("bucket", pa.int32()), ("signatures", pa.binary()), ("places", pa.binary()), ("records", pa.binary())])
    columns = "bucket int, signatures binary, places binary, records binary"

    def __init__(self, buckets: int):
        self.buckets, self.records, self.held, self.n = buckets, [], [], 0

    def add(self, record: tuple, entries: list[tuple[np.ndarray, int]]) -> None:
        for sig, role in entries:
            self.held.append((sig, 2 * len(self.records) + role))
            self.n += len(sig)
        self.records.append(np.array([record], dtype=SECOND))

    def flush(self) -> pa.RecordBatch:
        sig = np.concatenate([s for s, _ in self.held])
        place = np.repeat(np.array([p for _, p in self.held], dtype=np.int64), [len(s) for s, _ in self.held])
        records = np.concatenate(self.records)
        self.records, self.held, self.n = [], [], 0
        bucket = ((sig >> U64(32)) % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        found, starts = np.unique(bucket[order], return_index=True)
        sig, place = (sig & ID_BITS)[order], place[order]
        columns = [pa.array(found, pa.int32()), [], [], []]
        for a, b in zip(starts, np.r_[starts[1:], len(sig)], strict=True):
            here, at = np.unique(place[a:b] >> 1, return_inverse=True)
            columns[1].append(six(sig[a:b]))
            columns[2].append((2 * at + (place[a:b] & 1)).astype("<u4").tobytes())
            columns[3].append(records[here].tobytes())
        return pa.RecordBatch.from_arrays([columns[0], *[pa.array(c, pa.binary()) for c in columns[1:]]], schema=self.schema)


def second_signatures(asked: DataFrame, buckets: int, tasks: int) -> DataFrame:
    """Packed entries of the sets that have left out too many segments.

    Reads id, packed, root, lone and the names of the open signatures. Sets that stay short of
    segments are both probe and index entry under their open signatures. A set with
    so many shingles of its own that it is similar to none of the others gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, open_up = RecordPacker(tasks), zstandard.ZstdDecompressor()
        for batch in released(batches):
            for me, packed, root, lone, opened in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = shingles(word_hashes(open_up.decompress(packed)))
                common = len(h) - lone
                if 100 * common < PERCENT * len(h):
                    continue
                names, sketch = np.array(opened, dtype=np.int64).astype("<u8"), parities(h)
                for first in bands_of(len(h)):
                    light, found = allocate(h, first, names, buckets)
                    if found:
                        packer.add((me, root, len(h), common, light, sketch), found)
                if packer.n > HELD_ENTRIES:
                    yield packer.flush()
        if packer.n:
            yield packer.flush()

    return asked.select("id", "packed", "root", "lone", "opened").mapInArrow(run, RecordPacker.columns)


def name(packed: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Name of a frequent signature: a bucket's signatures are its own."""
    with np.errstate(over="ignore"):
        return packed + STEP * (bucket + U64(1))


def name_of(sig: np.ndarray, buckets: int) -> np.ndarray:
    return name(sig & ID_BITS, (sig >> U64(32)) % U64(buckets))


def allocate(h: np.ndarray, first: int, opened: np.ndarray, buckets: int) -> tuple[int, list[tuple[np.ndarray, int]]]:
    """Segments of one set in one band that are neither empty nor open, and its entries; none if these are enough.

    ``opened`` are the names of its open signatures, the least frequent first.
    """
    m = band(first)[2]
    terms = terms_of(h)
    k, starts, sums = segments(h, terms, first)
    sig = signature(k, sums, first)
    heavy = np.isin(name_of(sig, buckets), opened)
    usable = len(k) - int(heavy.sum())
    lack = most_apart(len(h), first) + 1 - usable
    if lack <= 0:
        return usable, []
    sizes = np.diff(np.r_[starts, len(h)])
    # one-deletion neighbours of all segments
    with np.errstate(over="ignore"):
        less = np.repeat(sums, sizes) - terms
    segment = np.repeat(k, sizes)
    less = signature(segment, less, first)
    out = [(mix(sig ^ FULL), INDEX), (mix(less ^ DELETED), INDEX)]
    # cost of a segment: the signatures to look up; one with a single shingle would look up all empty ones
    price = np.where(heavy | (sizes < 2), np.inf, 1.0 + sizes)
    chosen = np.argsort(price, kind="stable")[: min(lack, int(np.isfinite(price).sum()))]
    out.append((mix(sig[chosen] ^ DELETED), PROBE))
    out.append((mix(less[np.isin(segment, k[chosen])] ^ FULL), PROBE))
    if len(chosen) < lack:
        # as many of the others as are still needed, by the number of sets that have them; the empty ones last
        place = np.argsort(opened, kind="stable")
        mine = name_of(sig[heavy], buckets)
        mine = sig[heavy][np.argsort(place[np.searchsorted(opened, mine, sorter=place)], kind="stable")]
        empty = np.setdiff1d(np.arange(m, dtype=np.uint64), k)
        names = mix(np.concatenate([mine, signature(empty, np.zeros(len(empty), dtype=np.uint64), first)]) + STEP)
        out += [(names, INDEX), (names[: lack - len(chosen)], PROBE)]
    return usable, out


def second_candidates(entries: DataFrame) -> DataFrame:
    """a, b: a probing and an indexed set with a signature in common that may be similar, in different components.

    The shingles that only one of the sets has bound what two sets can share, and so do the segments of either that
    are not open: the two differ in each of them, or they would have been candidates before. Their parities bound
    in how many shingles they differ. No bound excludes a pair that is similar.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sig = from_six(b"".join(rows["signatures"]))
        sets = np.frombuffer(b"".join(rows["records"]), dtype=SECOND)
        ends = np.cumsum(rows["records"].str.len() // SECOND.itemsize)
        place = np.frombuffer(b"".join(rows["places"]), dtype="<u4") + 2 * np.repeat(np.r_[0, ends[:-1]], rows["places"].str.len() // 4)
        order = np.argsort(sig, kind="stable")
        sig, place = sig[order], place[order]
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        found: set[tuple[int, int]] = set()
        for start, end in zip(starts, np.r_[starts[1:], len(sig)], strict=True):
            if end - start < 2:
                continue
            entries = np.unique(place[start:end])
            group, role = sets[entries >> 1], entries & 1
            while len(group):
                size, common = group["size"].astype(np.int64), group["common"].astype(np.int64)
                possible = 9 * common >= 4 * (size + np.maximum(size.min(), -(-4 * size // 5)))
                if possible.all():
                    break
                group, role = group[possible], role[possible]
            if len(group) < 2 or (group["root"] == group["root"][0]).all():
                continue
            held = group[role == INDEX]
            for x in group[role == PROBE]:
                y = held[(held["root"] != x["root"])]
                y = y[9 * np.maximum(y["light"], x["light"]).astype(np.int64) <= y["size"].astype(np.int64) + int(x["size"])]
                size, common = y["size"].astype(np.int64), np.minimum(y["common"], x["common"]).astype(np.int64)
                y = y[9 * common >= 4 * (size + int(x["size"]))]
                apart = np.bitwise_count(y["sketch"] ^ x["sketch"]).sum(axis=1, dtype=np.int64)
                y = y[9 * apart <= y["size"].astype(np.int64) + int(x["size"])]
                found.update((min(int(x["id"]), i), max(int(x["id"]), i)) for i in y["id"].tolist())
        pair = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pair[:, 0], "b": pair[:, 1]})

    return entries.groupBy("bucket").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, from its whole text.

    Reads ``doc_id`` and ``text``. A null text, or one without words, has no shingles, is linked with nothing and keeps its
    own id as component. Rows that repeat an id are sets of their own. Rows without an id take part; the
    component's id is the smallest one there is. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    buckets = bucket_count(docs)
    rows = as_written_table(sets(docs), "sets")
    found = as_derived_table(candidates(signatures(docs, buckets)), "candidates")
    opened = found.where(F.col("kind") == OPEN).select(F.col("a").alias("signature"), F.col("b").alias("id"))
    facts = as_derived_table(_facts(found, opened), "facts")
    counts = found.where(F.col("kind") == FACT).groupBy(node_of("high", "low").alias("node")).agg(F.min("b").alias("n_shingles"))
    pairs = found.where(F.col("kind") == PAIR).select("a", "b", "n").union(_centred(opened, facts))
    pairs = as_derived_table(_possible(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), facts), "pairs")
    unsure = facts.where("heavy > spare").select("id")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(unsure).distinct()
    texts = as_written_table(texts_of(docs, wanted), "texts")
    numbers = as_derived_table(texts.select("id", "node").withColumn("number", F.monotonically_increasing_id()), "numbers")

    # one partner for each set: the one that shares most
    both = pairs.union(pairs.select("b", "a", "n"))
    first = both.groupBy("b").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("a"))
    first = as_derived_table(first.select("a", "b"), "pairs")
    mutual = first.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a > b")
    links = _numbered(verify(as_derived_table(first.join(mutual, ["a", "b"], "left_anti"), "pairs"), texts), numbers)
    roots = as_derived_table(_roots(links, numbers), "roots")
    # the others, as far as this has not joined them
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = as_derived_table(_apart(pairs.select("a", "b"), roots).join(done, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        links = as_derived_table(links.union(_numbered(verify(more, texts), numbers)), "links")
        roots = as_derived_table(_roots(links, numbers), "roots")
    # sets whose open signatures and empty segments leave too few
    named = opened.join(unsure, "id", "left_semi").join(roots.select("id", "root"), "id")
    still = named.groupBy("signature").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low <> high")
    rest = named.select("id", "signature").join(still.select("signature", "n"), "signature").select("id", "n", "signature")
    rest = rest.union(facts.where("spare < 0").select("id", F.lit(0).cast("long"), F.lit(0).cast("long")))
    # as many as a set has segments, the least frequent first
    rest = rest.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("n", "signature"))).alias("opened"))
    rest = rest.select("id", F.col("opened.signature").alias("opened"))
    asked = as_written_table(texts.join(rest, "id").join(roots.select("id", "root"), "id"), "texts")
    asked = asked.join(lone_shingles(asked, buckets), "id", "left").fillna(0, ["lone"])
    # fewer buckets than before: two sets meet once in each
    last = second_candidates(second_signatures(asked, buckets, -(-buckets // 4))).distinct()
    last = as_derived_table(last.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    if not last.isEmpty():
        links = as_derived_table(links.union(_numbered(verify(last, texts), numbers)), "links")
        roots = as_derived_table(_roots(links, numbers), "roots")
    return _labelled(rows, roots, counts)


def _facts(found: DataFrame, opened: DataFrame) -> DataFrame:
    """id, size, segments, spare, heavy (frequent signatures of the set, of all bands).

    Where two texts share an id, nothing is known: no segments are counted on, none can be spared.
    """
    one = F.count_distinct("b", "n", "spare") == 1
    facts = found.where(F.col("kind") == FACT).groupBy(F.col("a").alias("id")).agg(
        F.min("b").alias("size"),
        F.when(one, F.min("n")).otherwise(0).alias("segments"),
        F.when(one, F.min("spare")).otherwise(-1).alias("spare"),
    )
    heavy = opened.groupBy("id").agg(F.count(F.lit(1)).alias("heavy"))
    return facts.join(heavy, "id", "left").fillna(0, ["heavy"])


def _centred(opened: DataFrame, facts: DataFrame) -> DataFrame:
    """a, b, n = 0: the sets of each frequent signature with the one that has most frequent signatures."""
    weight = opened.join(facts.select("id", "heavy"), "id")
    centre = weight.groupBy("signature").agg(F.max_by("id", F.struct("heavy", "id")).alias("centre"))
    pairs = opened.join(centre, "signature").where("id <> centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
    return pairs.distinct().withColumn("n", F.lit(0).cast("long"))


def _possible(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs that share enough signatures to be similar.

    A difference of d touches at most d segments, so similar sets share all but d of the smaller one's segments. Frequent
    signatures that both have may be among these without having been counted for the pair.
    """
    def side(x: str) -> DataFrame:
        return facts.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("size", "segments", "heavy")])

    smaller = F.when(F.col("size_a") <= F.col("size_b"), F.col("segments_a")).otherwise(F.col("segments_b"))
    most = F.floor((F.col("size_a") + F.col("size_b")) / 9)
    shared = F.col("n") + F.least("heavy_a", "heavy_b")
    return pairs.join(side("a"), "a").join(side("b"), "b").where((shared >= smaller - most) | (smaller == 0)).select("a", "b", "n")


def _numbered(links: DataFrame, numbers: DataFrame) -> DataFrame:
    """Links of nodes as links of their numbers."""
    a = numbers.select(F.col("node").alias("a"), F.col("number").alias("na"))
    b = numbers.select(F.col("node").alias("b"), F.col("number").alias("nb"))
    return as_derived_table(links.join(a, "a").join(b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b")), "links")


def _roots(links: DataFrame, numbers: DataFrame) -> DataFrame:
    """id, node, root of every numbered set; its own number where it is linked with nothing."""
    found = components(links).withColumnRenamed("node", "number")
    return numbers.join(found, "number", "left").select("id", "node", F.coalesce("root", "number").alias("root"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of ids in different components."""
    a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
    return pairs.join(a, "a").join(b, "b").where("ra <> rb").select("a", "b").distinct()


def _labelled(rows: DataFrame, roots: DataFrame, counts: DataFrame) -> DataFrame:
    """Smallest document of each component, first per text, then per component; a text's shingles were counted with its signatures."""
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    placed = nodes.join(counts, "node", "left").join(roots.select("node", "root"), "node", "left")
    placed = as_derived_table(placed, "nodes")
    least = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("component"))
    label = placed.join(least, "root", "left").select("node", "n_shingles", F.coalesce("component", "least").alias("component_id"))
    return rows.join(label, "node", "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
