"""Phrase collocations: word sequences of a language that occur together far more often than their parts would.

Every n-gram of a text is a byte range of its normal form (words in lower case, one blank between them), and its Rabin-Karp
fingerprint is read off prefix polynomials modulo the prime 2**61 - 1: with S the running sum of byte * R**position,
the range from s to e has the fingerprint (S[e] - S[s]) * R**-s. Numpy takes the sums of a block of texts at once.

Passes over the texts count fingerprints of one, two, and three to five words; a longer n-gram is counted only if all shorter ones in it
were frequent, which a filter of bounded size tells. The filter can err towards "frequent", so can a fingerprint:
both only cost work. The last pass takes the n-grams that the filters let through, compares the occurrences of a fingerprint
with the text of the first one, which a pointer holds, and gives the phrase, its count and its first document; the shuffle adds up by
the phrase itself. So counts are of texts, and no text but that of frequent phrases leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.common import as_derived_table, bounded_batches, text_or_empty

# What separates words, and what separates pieces that no phrase crosses.
BLANKS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000

PRIME = (1 << 61) - 1
BASE = 1_234_567_890_123_456_789 % PRIME
SEGMENT = 1 << 16
BLOCK_BYTES = 2 * 1024 * 1024
# Entries that a task adds up before it sends them on.
HELD = 1_000_000
# Bits of a filter: so many per frequent fingerprint, and never more than the limit (32 MB).
BITS_EACH = 16
MAX_BITS = 1 << 28

_COUNTS = "lang string, size int, print long, n long"
_PHRASES = "lang string, size int, phrase string, n long, doc long"
_NO_DOC = np.iinfo(np.int64).max

_BREAK, _BLANK, _LETTER = 0, 1, 2
_KIND = np.full(256, _LETTER, np.uint8)
_KIND[list(BLANKS)] = _BLANK
_KIND[list(BREAKS)] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_U31, _U30, _U61 = np.uint64(31), np.uint64(30), np.uint64(61)
_LOW31, _LOW30, _P = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1), np.uint64(PRIME)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _U61)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1 for numbers below it."""
    ah, al, bh, bl = a >> _U31, a & _LOW31, b >> _U31, b & _LOW31
    middle = ah * bl + al * bh
    return _reduced(((ah * bh) << np.uint64(1)) + (middle >> _U30) + ((middle & _LOW30) << _U31) + al * bl)


def _powers(base: int, n: int) -> np.ndarray:
    found = np.ones(1, np.uint64)
    while len(found) < n:
        found = np.concatenate([found, times(found, np.uint64(pow(base, len(found), PRIME)))])
    return found[:n]


_INVERSE = pow(BASE, -1, PRIME)
_tables: list[np.ndarray] = []


def _segment_tables() -> list[np.ndarray]:
    """Powers of the base over one segment, in two halves, and those of its inverse; one set per process."""
    if not _tables:
        up = _powers(BASE, SEGMENT)
        _tables.extend([up >> _U31, up & _LOW31, _powers(_INVERSE, SEGMENT)])
    return _tables


def _sums_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sum of (byte + 1) * R**position below each of the places, which ascend."""
    high, low, _ = _segment_tables()
    out = np.empty(len(places), np.uint64)
    total = 0
    edges = np.searchsorted(places, np.arange(0, len(data) + SEGMENT, SEGMENT))
    for k in range(len(edges) - 1):
        part = data[k * SEGMENT : (k + 1) * SEGMENT].astype(np.uint64) + np.uint64(1)
        h, l = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * t[: len(part)])]) for t in (high, low))
        local = np.append(places[edges[k] : edges[k + 1]] - k * SEGMENT, len(part))
        value = _reduced(times(_reduced(h[local]), np.uint64(1 << 31)) + _reduced(l[local]))
        value = times(value, np.uint64(pow(BASE, k * SEGMENT, PRIME)))
        value = _reduced(value + np.uint64(total))
        out[edges[k] : edges[k + 1]], total = value[:-1], int(value[-1])
    out[edges[-1] :] = total
    return out


def _back(places: np.ndarray) -> np.ndarray:
    """R**-place."""
    inverse = _segment_tables()[2]
    whole = _powers(pow(_INVERSE, SEGMENT, PRIME), int(places[-1]) // SEGMENT + 1 if len(places) else 1)
    return times(whole[places // SEGMENT], inverse[places % SEGMENT])


class Block:
    """Texts of one language in normal form, with their words' places and prefix sums."""

    def __init__(self, texts: list[bytes], docs: list[int]) -> None:
        raw = np.frombuffer(b"\n" + b"\n".join(texts), np.uint8)
        kind = _KIND[raw]
        letter = kind == _LETTER
        starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
        pieces = np.cumsum(kind == _BREAK, dtype=np.int32)
        self.piece = pieces[starts]
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        self.doc = np.array(docs, np.int64)[np.searchsorted(np.cumsum(lengths), starts - 1, "right")]
        keep = letter.copy()
        keep[starts - 1] = True  # the separator before each word, as one blank
        self.data = _LOWER[raw[keep]]
        place = np.cumsum(keep, dtype=np.int64) - 1
        self.start = place[starts]
        self.data[self.start - 1] = ord(" ")
        self.end = np.append(self.start[1:] - 1, len(self.data))[: len(starts)]
        self.words = len(starts)
        sums = _sums_at(self.data, np.stack([self.start, self.end], axis=1).reshape(-1))
        self._low, self._high = sums[::2], sums[1::2]
        self._back = _back(self.start)

    def prints(self, first: np.ndarray, size: int, bits: int = 61) -> np.ndarray:
        """Fingerprints of the n-grams of ``size`` words that begin at the given words."""
        range_sum = _reduced(self._high[first + size - 1] + _P - self._low[first])
        return times(range_sum, self._back[first]) & np.uint64((1 << bits) - 1)

    def bytes_of(self, first: int, size: int) -> bytes:
        return self.data[self.start[first] : self.end[first + size - 1]].tobytes()

    def same_word(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words have the same bytes."""
        same = (self.end[a] - self.start[a]) == (self.end[b] - self.start[b])
        todo = np.flatnonzero(same & (a != b))
        at = 0
        while at < len(todo):  # some megabytes of letters at a time
            n = self.end[a[todo[at:]]] - self.start[a[todo[at:]]]
            upto = at + max(1, int(np.searchsorted(np.cumsum(n), BLOCK_BYTES)))
            n, part = n[: upto - at], todo[at:upto]
            run = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            equal = self.data[np.repeat(self.start[a[part]], n) + run] == self.data[np.repeat(self.start[b[part]], n) + run]
            same[part] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
            at = upto
        return same


class Filter:
    """Which fingerprints may be frequent: a bitmap of a power of two of bits."""

    def __init__(self, bitmap: np.ndarray) -> None:
        self.bitmap, self.mask = bitmap, np.uint64(len(bitmap) * 8 - 1)

    def __call__(self, lang: str, size: int, prints: np.ndarray) -> np.ndarray:
        at = (prints ^ np.uint64(_salt(lang, size))) & self.mask
        return (self.bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _salt(lang: str, size: int) -> int:
    return xxhash.xxh64_intdigest(f"{size}:{lang}".encode(), seed=42) & PRIME  # as F.xxhash64


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, Block]]:
    """The texts of a batch by language, in blocks of some megabytes; a text is never cut."""
    by_lang: dict[str, tuple[list[bytes], list[int], list[int]]] = {}
    ids = batch.column("doc").to_pylist()
    for lang, text, doc in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), ids):
        texts, docs, size = by_lang.setdefault(lang, ([], [], [0]))
        texts.append(text)
        docs.append(_NO_DOC if doc is None else doc)
        size[0] += len(text)
        if size[0] >= BLOCK_BYTES:
            del by_lang[lang]
            yield lang, Block(texts, docs)
    for lang, (texts, docs, _) in by_lang.items():
        yield lang, Block(texts, docs)


def _surviving(
    lang: str, block: Block, upto: int, filters: dict[int, Filter], bits: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first words, fingerprints) of the n-grams in which nothing shorter is known to be rare."""
    ok = np.ones(block.words, bool)
    for size in range(1, upto + 1):
        if size > 1:
            ok = ok[:-1] & ok[1:] if len(ok) else ok
            if size == 2:
                ok &= block.piece[:-1] == block.piece[1:]
        first = np.flatnonzero(ok)
        if not len(first):
            return
        found = block.prints(first, size, bits)
        if size in filters:
            passed = filters[size](lang, size, found)
            first, found = first[passed], found[passed]
            ok = np.zeros(len(ok), bool)
            ok[first] = True
        yield size, first, found


def _counter(sizes: tuple[int, ...], shared, bits: int) -> Callable:
    """Counts of the fingerprints of the given sizes; size 0 counts all words of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {s: Filter(b) for s, b in shared.value.items()}
        held: dict[tuple[str, int], list] = {}
        entries = 0

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            prints, n = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(prints, kind="stable")
            prints, n = prints[order], n[order]
            starts = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.zeros(0, np.int64)
            return prints[starts], np.add.reduceat(n, starts) if len(starts) else n

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, size), parts in held.items():
                prints, n = merged(parts)
                for i in range(0, len(prints), 50_000):
                    p = prints[i : i + 50_000].astype(np.int64)
                    columns = [pa.array([lang] * len(p), pa.string()), np.full(len(p), size, np.int32), p, n[i : i + 50_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["lang", "size", "print", "n"])
            held.clear()

        for batch in batches:
            for lang, block in _blocks(batch):
                if 1 in sizes:
                    held.setdefault((lang, 0), []).append((np.zeros(1, np.uint64), np.array([block.words], np.int64)))
                for size, _, prints in _surviving(lang, block, max(sizes), filters, bits):
                    if size in sizes:
                        values, n = np.unique(prints, return_counts=True)
                        held.setdefault((lang, size), []).append((values, n.astype(np.int64)))
                        entries += len(values)
            if entries > HELD:
                for key in list(held):
                    held[key] = [merged(held[key])]
                entries = sum(len(parts[0][0]) for parts in held.values())
                if entries > HELD // 2:
                    yield from sent()
                    entries = 0
        yield from sent()

    return count


def _verified(block: Block, grams: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, pointers, counts, documents): groups of n-grams with the same text.

    The occurrences of a fingerprint are compared with the first one: words by their bytes, longer n-grams by the groups of
    all but the last word and of the last word, which are known to be right. Where they differ, the group is parted.
    """
    group = np.full(block.words, -1, np.int64)
    word = group
    for size, first, prints in grams:
        if not len(first):
            continue
        order = np.argsort(prints, kind="stable")
        first, prints = first[order], prints[order]
        new = np.append(True, prints[1:] != prints[:-1])
        number = np.cumsum(new) - 1
        pointer = first[np.flatnonzero(new)][number]
        if size == 1:
            same = block.same_word(first, pointer)
        else:
            last = size - 1
            same = (group[first] == group[pointer]) & (word[first + last] == word[pointer + last])
        if not same.all():
            if size == 1:
                texts: dict[bytes, int] = {}
                key = np.array([texts.setdefault(block.bytes_of(i, 1), len(texts)) for i in first])
            else:
                key = np.unique(np.stack([group[first], word[first + size - 1]]), axis=1, return_inverse=True)[1].reshape(-1)
            order = np.argsort(key, kind="stable")
            first, key = first[order], key[order]
            new = np.append(True, key[1:] != key[:-1])
            number = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        group = np.full(block.words, -1, np.int64)
        group[first] = number
        if size == 1:
            word = group
        yield size, first[starts], np.diff(np.append(starts, len(first))), np.minimum.reduceat(block.doc[first], starts)


def _reader(upto: int, shared, bits: int) -> Callable:
    """Text, count and first document of the n-grams that the filters let through."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {s: Filter(b) for s, b in shared.value.items()}
        held: dict[tuple[str, int, bytes], list[int]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            keys = list(held)
            for i in range(0, len(keys), 50_000):
                part = keys[i : i + 50_000]
                values = [held[k] for k in part]
                columns = [
                    pa.array([k[0] for k in part], pa.string()), pa.array([k[1] for k in part], pa.int32()),
                    pa.array([k[2].decode() for k in part], pa.string()), pa.array([v[0] for v in values], pa.int64()),
                    pa.array([None if v[1] == _NO_DOC else v[1] for v in values], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "n", "doc"])
            held.clear()

        for batch in batches:
            for lang, block in _blocks(batch):
                grams = _surviving(lang, block, upto, filters, bits)
                for size, pointer, n, doc in _verified(block, grams):
                    for p, count, d in zip(pointer.tolist(), n.tolist(), doc.tolist()):
                        key = (lang, size, block.bytes_of(p, size))
                        if key in held:
                            entry = held[key]
                            entry[0] += count
                            entry[1] = min(entry[1], d)
                        else:
                            held[key] = [count, d]
            if len(held) > HELD // 4:
                yield from sent()
        yield from sent()

    return read


def _bitmap(frequent: DataFrame, size: int) -> np.ndarray:
    """Filter over the fingerprints of one size: at most MAX_BITS bits come to the driver, whatever their number."""
    rows = frequent.where(F.col("size") == size)
    bits = 1 << 15
    while bits < min(MAX_BITS, BITS_EACH * rows.count()):
        bits *= 2
    salt = F.xxhash64(F.concat(F.lit(f"{size}:"), F.col("lang"))).bitwiseAND(F.lit(PRIME))
    at = F.col("print").bitwiseXOR(salt).bitwiseAND(F.lit(bits - 1))
    parts = rows.select(at.alias("at")).groupBy(F.floor(F.col("at") / 32768).alias("part"))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("map")).toLocalIterator():
        out[r.part * 4096 : (r.part + 1) * 4096] = np.frombuffer(r.map, np.uint8)
    return out


def frequent_phrases(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, bits: int = 61
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, n, doc) of all word sequences with at least ``min_count`` occurrences, and (lang, n) of all words.

    ``doc`` is the smallest id of a document that holds the phrase. Both are written tables. ``bits`` shortens the
    fingerprints; the result does not depend on it.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    doc = F.col("doc_id").cast("long").alias("doc")
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"), doc)
    found: dict[int, np.ndarray] = {}
    totals = None
    for sizes in ((1,), (2,), tuple(range(3, max_words + 1))):
        sizes = tuple(s for s in sizes if s <= max_words)
        if not sizes:
            continue
        rows = texts.mapInArrow(_counter(sizes, spark.sparkContext.broadcast(dict(found)), bits), _COUNTS)
        counted = rows.groupBy("lang", "size", "print").agg(F.sum("n").alias("n"))
        counted = as_derived_table(counted.where((F.col("size") == 0) | (F.col("n") >= min_count)), "fingerprints")
        if totals is None:
            totals = counted.where((F.col("size") == 0) & (F.col("n") > 0)).select("lang", "n")
        found |= {s: _bitmap(counted, s) for s in sizes}
    read = texts.mapInArrow(_reader(max_words, spark.sparkContext.broadcast(found), bits), _PHRASES)
    phrases = read.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"), F.min("doc").alias("doc"))
    return as_derived_table(phrases.where(F.col("n") >= min_count), "phrases"), totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, size, phrase, a, l, r, n, score, doc): each phrase of two or more words at its weakest cut.

    floor(1000 * a * n / (l * r)) is exact: products are decimals of up to 38 digits.
    """
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    whole = phrases.where("size > 1").withColumnRenamed("n", "a").join(totals, "lang")
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("front", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))
    cuts = cuts.join(parts.select("lang", F.col("part").alias("front"), F.col("f").alias("l")), ["lang", "front"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    big = {c: f"CAST({c} AS DECIMAL(17, 0))" for c in "anlr"}
    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {big['a']} * {big['n']}) div ({big['l']} * {big['r']})")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "size", "phrase", "a", "n", "doc").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "size", "phrase", "a", "b.l", "b.r", "n", "b.score", "doc")


def _inside(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): for phrases that lie inside a longer one, the greatest count of such."""
    words = candidates.where("size > 2").withColumn("w", F.split("phrase", " "))
    spans = words.withColumn("m", F.explode(F.expr("sequence(2, size - 1)")))
    spans = spans.withColumn("i", F.explode(F.expr("sequence(1, size - m + 1)")))
    inner = spans.select("lang", F.expr("array_join(slice(w, i, m), ' ')").alias("phrase"), "a")
    return inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, bits: int = 61
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score, doc.

    Null and empty texts have no words, a null lang counts as ``und``, a null id is no first document. Texts of any length are read
    whole, repeated rows count each time, ties end at the phrase's bytes, a table without frequent phrases gives no
    rows. Columns other than doc_id, text and lang are not read.
    """
    phrases, totals = frequent_phrases(docs, max_words, min_count, bits)
    candidates = as_derived_table(scored(phrases, totals), "candidates")
    kept = candidates.join(_inside(candidates), ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc")


def collocations_sql() -> str:
    """The same in DuckDB, by counting all word sequences as lists."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
        f AS (
            SELECT lang, size, phrase, count(*) AS n FROM (
                SELECT lang, s.size, array_to_string(w[i:i + s.size - 1], ' ') AS phrase
                FROM places, range(1, {MAX_WORDS + 1}) s(size) WHERE i + s.size - 1 <= len(w))
            GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
        cuts AS (
            SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w, k
            FROM f, range(1, {MAX_WORDS}) t(k) WHERE size > 1 AND k < size),
        rated AS (
            SELECT c.lang, c.size, c.phrase, c.a, t.n, l.n AS l, r.n AS r, c.k,
                   CAST((1000::HUGEINT * c.a * t.n) // (l.n::HUGEINT * r.n) AS BIGINT) AS score
            FROM cuts c JOIN totals t USING (lang)
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')),
        candidates AS (
            SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        kept AS (
            SELECT * FROM candidates c WHERE NOT EXISTS (
                SELECT 1 FROM candidates d WHERE d.lang = c.lang AND d.size > c.size AND 100 * d.a >= 100 * c.a
                    AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}"""
