"""Language identification with Bloom filters whose slots are language bitmasks.

An n-gram is a window of four bytes of the lower-cased text. The filter has one bit per language and
slot, all languages of a slot side by side, so that the AND of a few slots gives every language that holds the
n-gram. A text's hits per language are counted and corrected by each language's rate of false hits; the largest count
decides. A language holds an n-gram if it uses it at least a quarter as often as the language that uses it most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import bounded_batches, held_out, text_or_empty
from brisa.llm.perfect_hash import mix

# About so many documents of each language are learned from, chosen by a hash of their id.
TRAIN_DOCUMENTS = 600
MIN_SHARE = 0.25
MIN_COUNT = 2
HASHES = 2
SLOTS_PER_GRAM = 16
WIDTH = 4
BLOCK_BYTES = 1 << 20

# ASCII that is no letter becomes a blank; all other bytes stay.
LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
GAP = b" " * WIDTH


def prepare(text: str) -> bytes:
    return text.lower().encode().translate(LETTERS)


def grams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows as numbers, and which of them count: those with letters in the middle."""
    b = np.frombuffer(data, dtype=np.uint8)
    if len(b) < WIDTH:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=bool)
    wide = b.astype(np.uint32)
    n = len(b) - WIDTH + 1
    value = wide[:n] | (wide[1 : n + 1] << 8) | (wide[2 : n + 2] << 16) | (wide[3 : n + 3] << 24)
    return value, (b[1 : n + 1] != 32) & (b[2 : n + 2] != 32)


@dataclass
class Filters:
    """``planes``: for each 64 languages a mask per slot."""

    languages: list[str]
    documents: list[int]
    planes: list[np.ndarray]

    def __post_init__(self):
        self.false_rate = []
        for i in range(len(self.languages)):
            plane, bit = self.planes[i // 64], i % 64
            fill = float(np.mean((plane >> plane.dtype.type(bit)) & plane.dtype.type(1)))
            self.false_rate.append(fill**HASHES)

    @classmethod
    def build(cls, languages: list[str], documents: list[int], held: list[np.ndarray]) -> Filters:
        """``held``: the n-grams of each language."""
        size = 1 << max(10, int(np.ceil(np.log2(SLOTS_PER_GRAM * max(1, max(map(len, held), default=1))))))
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        planes = [np.zeros(size, dtype=kind) for _ in range(0, max(1, len(languages)), 64)]
        for i, values in enumerate(held):
            for at in slots(values, size):
                planes[i // 64][at] |= kind(1 << (i % 64))
        return cls(languages, documents, planes)

    def hits(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each run of n-grams (they begin at ``starts``, none is empty) the hits of each language."""
        out = np.zeros((len(starts), len(self.languages)), dtype=np.int64)
        where = slots(values, len(self.planes[0]))
        for p, plane in enumerate(self.planes):
            mask = plane[where[0]]
            for at in where[1:]:
                mask &= plane[at]
            for i in range(64 * p, min(64 * p + 64, len(self.languages))):
                one = (mask >> plane.dtype.type(i % 64)) & plane.dtype.type(1)
                out[:, i] = np.add.reduceat(one, starts, dtype=np.int64)
        return out

    def decide(self, hits: np.ndarray, total: int) -> tuple[str, float]:
        """The language with the most hits beyond its false ones, and its part of all of them."""
        real = [max(0.0, (h - total * f) / (1 - f)) if f < 1 else 0.0 for h, f in zip(hits.tolist(), self.false_rate, strict=True)]
        best = min(range(len(real)), key=lambda i: (-real[i], -self.documents[i], self.languages[i]))
        whole = sum(real)
        return self.languages[best], real[best] / whole if whole else 0.0


def slots(values: np.ndarray, size: int) -> list[np.ndarray]:
    h = mix(values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    bits = np.uint64(size - 1)
    return [((h >> np.uint64(24 * j)) & bits).astype(np.int64) for j in range(HASHES)]


def train(docs: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> Filters:
    """Filters from the rows that may be learned from and have a language and a text."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, train_documents / n))]) if counts else None
    if share is None:
        return Filters([], [], [np.zeros(1, dtype=np.uint8)])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(prepare(text))
            for lang, parts in texts.items():
                values, used = grams(GAP + GAP.join(parts) + GAP)
                found, n = np.unique(values[used], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    found = chosen.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    table = found.toPandas()  # bounded by the sample
    table["share"] = table["n"] / table.groupby("lang")["n"].transform("sum")
    table = table[(table["share"] >= MIN_SHARE * table.groupby("gram")["share"].transform("max")) & (table["n"] >= MIN_COUNT)]
    held = [table.loc[table["lang"] == lang, "gram"].to_numpy(dtype=np.uint32) for lang in languages]
    return Filters.build(languages, [counts[x] for x in languages], held)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if no language was
    learned. A text whose n-grams are all unknown gets the language with the most learned rows, score 0.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(filters)  # its size follows the training sample

    def blocks(texts: list[str]) -> Iterator[list[tuple[int, bytes]]]:
        block, size = [], 0
        for i, text in enumerate(texts):
            data = prepare(text)
            # a long text goes on in the next block, with the bytes that its last windows need
            for at in range(0, max(1, len(data)), BLOCK_BYTES):
                piece = (GAP if at == 0 else b"") + data[at : at + BLOCK_BYTES + WIDTH - 1] + GAP
                if at + BLOCK_BYTES < len(data):
                    piece = piece[: -len(GAP)]
                block.append((i, piece))
                size += len(piece)
                if size >= BLOCK_BYTES:
                    yield block
                    block, size = [], 0
        if block:
            yield block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            hits = np.zeros((len(texts), len(f.languages)), dtype=np.int64)
            total = np.zeros(len(texts), dtype=np.int64)
            for block in blocks(texts) if f.languages else ():
                pieces = [p for _, p in block]
                values, used = [], []
                for p in pieces if len(pieces) == 1 else [b"".join(pieces)]:
                    values, used = grams(p)
                ends = np.cumsum([len(p) for p in pieces])
                kept = np.flatnonzero(used)
                owner = np.searchsorted(ends, kept, side="right")
                if not len(kept):
                    continue
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                rows = np.array([i for i, _ in block])[owner[starts]]
                np.add.at(hits, rows, f.hits(values[kept], starts))
                np.add.at(total, rows, np.diff(np.r_[starts, len(kept)]))
            names, scores = [], []
            for i, text in enumerate(texts):
                if not f.languages or not any(map(str.isalpha, text)):
                    names.append("und")
                    scores.append(0.0)
                else:
                    name, score = f.decide(hits[i], int(total[i]))
                    names.append(name)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
