"""Byte-level BPE, encoding and decoding.

A text is cut into pre-tokens by the tokenizer's pattern. The distinct ones of a block of texts are resolved
together, in two tiers: a minimal perfect hash over the vocabulary finds those that are a token as they
stand (the token's bytes at that index are compared, so no hash decides); the others are merged. A short one, as words are, has
the ranks of its neighbouring pairs in a list, whose least is looked up after each step; a longer one has them in a heap over a
linked list of its bytes, which takes n log n steps for n bytes.

The vocabulary is a fixed file, so that its tables have a fixed size; they are broadcast once.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice, pairwise
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from brisa.llm.common import bounded_batches, released, text_or_empty
from brisa.llm.perfect_hash import PerfectHash, keys_of

# Pre-tokens that a worker remembers, some 25 MB; when there would be more, those not met for the longest are forgotten. A worker outlives its
# stage, and with it this.
REMEMBERED = 150_000
# Bytes of a piece from which the heap is faster than a look at all its pairs.
HEAP_BYTES = 48
# Characters of text that are cut into pre-tokens at once.
BLOCK_CHARS = 500_000
BLOCK_TOKENS = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Vocabulary:
    """Two tables by the index of the perfect hash (token bytes, id) and the token bytes by id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        tokens = list(ranks)
        hi, lo = keys_of([xxhash.xxh3_128_digest(t) for t in tokens])
        self.index = PerfectHash.build(hi, lo)
        place = self.index.lookup(hi, lo)
        self.token_at: list[bytes] = [b""] * len(tokens)
        self.id_at: list[int] = [0] * len(tokens)
        for p, t in zip(place, tokens, strict=True):
            self.token_at[p], self.id_at[p] = t, ranks[t]
        self.token_of = {i: t for t, i in ranks.items()}
        self.no_rank = max(self.token_of) + 1  # above all ranks

    def whole(self, pieces: list[bytes]) -> list[int | None]:
        """Ids of the pieces that are tokens, None for the others."""
        hi, lo = keys_of([xxhash.xxh3_128_digest(p) for p in pieces])
        return [
            self.id_at[i] if i >= 0 and self.token_at[i] == p else None
            for i, p in zip(self.index.lookup(hi, lo).tolist(), pieces, strict=True)
        ]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: of all neighbours the pair of lowest rank, leftmost first, becomes one, until none is left."""
        return self.merge_short(piece) if len(piece) < HEAP_BYTES else self.merge_long(piece)

    def merge_short(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        get, none = ranks.get, self.no_rank
        starts = list(range(n + 1))  # of the parts, and the end
        rank = [get(piece[i : i + 2], none) for i in range(n - 1)]  # of each part with the next
        while rank and (r := min(rank)) != none:
            i = rank.index(r)
            del starts[i + 1], rank[i]
            if i < len(rank):
                rank[i] = get(piece[starts[i] : starts[i + 2]], none)
            if i:
                rank[i - 1] = get(piece[starts[i - 1] : starts[i + 1]], none)
        return [ranks[piece[i:j]] for i, j in pairwise(starts)]

    def merge_long(self, piece: bytes) -> list[int]:
        get, n = self.ranks.get, len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank = [-1] * n  # of the pair that begins here, -1 if it is no token
        heap = []
        for i in range(n - 1):
            if (r := get(piece[i : i + 2])) is not None:
                rank[i] = r
                heap.append(r * n + i)
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            if rank[i] != r:  # one of its sides has been merged with something else
                continue
            j = after[i]
            whole = part[i] = part[i] + part[j]
            part[j], rank[j], rank[i] = None, -1, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get(whole + part[k])) is not None:
                    rank[i] = r
                    heapq.heappush(heap, r * n + i)
            h = before[i]
            if h >= 0:
                rank[h] = -1
                if (r := get(part[h] + whole)) is not None:
                    rank[h] = r
                    heapq.heappush(heap, r * n + h)
        ranks = self.ranks
        return [ranks[p] for p in part if p is not None]


class Encoder:
    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}  # packed ids of a pre-token
        self.older: dict[str, bytes] = {}  # those not met since ``known`` was begun

    def pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= BLOCK_CHARS:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while block := list(islice(found, BLOCK_TOKENS)):
            yield block

    def learn(self, new: list[str]) -> None:
        raw = [p.encode() for p in new]
        for piece, data, whole in zip(new, raw, self.vocabulary.whole(raw), strict=True):
            ids = [whole] if whole is not None else self.vocabulary.merge(data)
            self.known[piece] = pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. Short texts share a block, so that their new pre-tokens are resolved together."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, chars = at + 1, len(texts[at])
            while end < len(texts) and chars + len(texts[end]) <= BLOCK_CHARS:
                chars += len(texts[end])
                end += 1
            if end - at > 1:
                cut = [self.pattern.findall(t) for t in texts[at:end]]
                self.resolve(set().union(*cut))
                out.extend(b"".join(map(self.known.__getitem__, c)) for c in cut)
            else:
                packed = []
                for c in self.pieces(texts[at]):
                    self.resolve(set(c))
                    packed.append(b"".join(map(self.known.__getitem__, c)))
                out.append(b"".join(packed))
            at = end
        return out

    def resolve(self, pieces: set[str]) -> None:
        """Has all the pieces known. Each half of what is remembered holds what was met since the other was begun."""
        if new := pieces.difference(self.known):
            if len(self.known) + len(new) > REMEMBERED // 2:
                self.older, self.known = self.known, {}
                new = pieces
            if len(self.older) + len(self.known) + len(new) > REMEMBERED:  # a block alone has more than half
                self.older = {}
            met = {p: ids for p in new if (ids := self.older.pop(p, None)) is not None}
            self.known.update(met)
            self.learn(list(new.difference(met)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.token_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder(vocabulary, pattern: str) -> Encoder:
    """One encoder per worker and vocabulary; ``vocabulary`` is the broadcast one."""
    key = (vocabulary.id, pattern) if hasattr(vocabulary, "id") else (id(vocabulary), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(vocabulary.value), pattern)
    return _encoders[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers, binary) of every row.

    Reads ``doc_id`` and ``text``, whole. A null or empty text has no ids. No special tokens: their strings
    are ordinary text. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shared, pattern)
        for batch in released(batches):
            ids = e.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of the ids of every row; null ids count as none."""
    spark: SparkSession = encoded.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shared, pattern)
        for batch in released(batches):
            data = [e.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encodes and decodes in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shared, pattern)
        for batch in released(batches):
            n, ids_sha, data_sha = [], [], []
            for ids in e.encode(batch.column(1).to_pylist()):
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                data_sha.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(data_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, schema)
