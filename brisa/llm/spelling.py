"""Spelling variants: words of a corpus that differ by one edit, and the common form that each belongs to.

The vocabulary is cut into buckets that hold every pair of near words once. Two words of m and m or m + 1 code points that
differ by one edit share their first m // 2 code points, or else their last m - m // 2, so each word goes to the
bucket of its first half and to that of its last half, for m its own length and one less. A bucket of words that share
more than fits into a task is cut in the same way again, in the part that its words do not share; at the end two words
of a bucket differ in one place, so that the alphabet bounds it. A pair belongs to the bucket whose share of places its
common prefix ends in, hence it is found once.

A bucket is a sorted list, read from the end that its words share. Each word of m code points is compared with the whole list
by the rows of the edit matrix, of which only the three cells about the diagonal can be 1 or less: the list is walked by common
prefixes, so the row after a prefix is computed once for all words that share it (adjacent words' longest common
prefixes say where it ends), and a range whose row has no cell of 1 or less is skipped. The walk goes level by level
for many words of many buckets at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import as_derived_table, bounded_batches

# Letters of a word, all of them in Latin-1.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_LENGTH = 7
MIN_COUNT = 2
DAMAGE = 31
RATIO = 10

# A bucket with more letters than this is cut again; a task reads about as many at once.
BUCKET_LETTERS = 2_000_000
BLOCK_ROWS = 100_000
BLOCK_BYTES = 8_000_000
# Words compared at a time.
QUERIES = 1024

_ANY = 1 << 30
_ROW = "word string, near long, best_n long, best string"


def vocabulary(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int = DAMAGE
) -> DataFrame:
    """Words of all texts with their number of occurrences.

    A word is a maximal run of letters in which A-Z are lower-cased; one occurrence in ``damage``, chosen by the crc32 of
    ``<doc_id>:<run>``, loses one code point. A null text has no words, a null id counts as empty text.
    """
    # shorter runs are left out at once: no run becomes longer
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("raw"))
    rows = rows.select("id", F.translate("raw", UPPER, LOWER).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    cut = F.expr("concat(left(run, CAST(h % length(run) AS INT)), substr(run, CAST(h % length(run) AS INT) + 2))")
    rows = rows.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = rows.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _bucket(m: Column, s: Column, t: Column, end: Column) -> Column:
    """A share of the pairs of words: m the shorter's length, s and t what they share in front and behind, and their common prefix below end."""
    return F.struct(m.alias("m"), s.alias("s"), t.alias("t"), end.alias("end"))


def _first_buckets(words: DataFrame, min_length: int) -> DataFrame:
    size = F.length("word")
    found = []
    for m in (size, size - 1):
        half = F.floor(m / 2).cast("int")
        found += [_bucket(m, half, F.lit(0), F.lit(_ANY)), _bucket(m, F.lit(0), m - half, half)]
    rows = words.select("word", "n", F.explode(F.array(*found)).alias("b"))
    return rows.select("word", "n", "b.*").where(F.col("m") >= min_length)


def _halved(rows: DataFrame) -> DataFrame:
    """The same pairs in buckets that share half of what was not shared yet."""
    m, s, t, end = (F.col(c) for c in ("m", "s", "t", "end"))
    half = F.floor((m - s - t) / 2).cast("int")
    both = F.array(
        _bucket(m, s + half, t, end), _bucket(m, s, m - s - half, F.least(end, s + half))
    )
    rows = rows.select("word", "n", F.explode(both).alias("b")).select("word", "n", "b.*")
    return rows.where(F.col("s") < F.col("end"))


_KEY = ["m", "s", "t", "end", "head", "tail"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("head", F.expr("left(word, s)")).withColumn("tail", F.expr("right(word, t)"))


def _fitting(words: DataFrame, min_length: int, letters: int) -> DataFrame:
    """Rows (word, n, m, s, t, end) whose buckets all fit into a task, or differ in one place only."""
    done, open_rows = None, _first_buckets(words, min_length)
    while True:
        sizes = _keyed(open_rows).groupBy(*_KEY).agg(F.sum(F.length("word")).alias("letters"))
        large = (F.col("letters") > letters) & (F.col("m") - F.col("s") - F.col("t") > 1)
        hot = as_derived_table(sizes.where(large).select(*_KEY), "large-buckets")
        if hot.isEmpty():
            return open_rows if done is None else done.unionByName(open_rows)
        keyed = _keyed(open_rows)
        fits = keyed.join(hot, _KEY, "left_anti").drop("head", "tail")
        done = fits if done is None else done.unionByName(fits)
        open_rows = as_derived_table(_halved(keyed.join(hot, _KEY, "left_semi").drop("head", "tail")), "halved")


class SortedList:
    """Words of one m in the order of their buckets, and within these from the end that they share.

    ``codes`` has one row per word and m + 1 columns; a word of m code points ends with 0. ``lead`` code points are shared.
    """

    def __init__(self, codes: np.ndarray, lead: int, new_bucket: np.ndarray) -> None:
        self.codes, self.lead, self.m = codes, lead, codes.shape[1] - 1
        n = len(codes)
        self.lcp = np.zeros(n, np.int32)
        differs = codes[1:] != codes[:-1]
        self.lcp[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), self.m + 1)
        starts = new_bucket | (self.lcp < lead)
        starts[0] = True
        self.lcp[starts] = -1
        bucket = np.cumsum(starts) - 1
        edges = np.append(np.flatnonzero(starts), n)
        self.low, self.high = edges[bucket].astype(np.int32), edges[bucket + 1].astype(np.int32)
        self.n = n
        self._heads: dict[int, np.ndarray] = {}

    def heads(self, d: int) -> np.ndarray:
        """Rows where a prefix of d + 1 code points begins."""
        if d not in self._heads:
            self._heads[d] = np.append(np.flatnonzero(self.lcp <= d), self.n).astype(np.int32)
        return self._heads[d]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) of rows that differ by one edit. Queries have m code points."""
        m, codes = self.m, self.codes
        query, low, high = queries, self.low[queries], self.high[queries]
        # after d equal code points the row about the diagonal is 1, 0, 1
        a = np.ones(len(query), np.int8)
        b, c = np.zeros(len(query), np.int8), np.ones(len(query), np.int8)
        for d in range(self.lead, m + 1):
            heads = self.heads(d)
            first = np.searchsorted(heads, low)
            count = np.searchsorted(heads, high) - first
            row = np.repeat(np.arange(len(query), dtype=np.int32), count)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count - first, count)
            low, high = heads[place], heads[place + 1]
            query, a, b, c = query[row], a[row], b[row], c[row]
            code = codes[low, d]
            before = codes[query, d - 1] if d else np.zeros(len(query), codes.dtype)
            left = np.minimum(a + (code != before), b + 1)
            if d == m:
                hit = np.where(code == 0, b, left) == 1
                return query[hit], low[hit]
            middle = np.minimum(np.minimum(b + (code != codes[query, d]), c + 1), left + 1)
            right = np.minimum(c + (code != codes[query, d + 1]), middle + 1)
            alive = np.flatnonzero((left <= 1) | (middle <= 1) | (right <= 1))
            query, low, high = query[alive], low[alive], high[alive]
            a, b, c = left[alive], middle[alive], right[alive]
        raise AssertionError("no column past the last")


def _codes(items: pa.Array, m: int) -> np.ndarray:
    """One row per word, one byte per code point, 0 behind the end."""
    offsets = np.frombuffer(items.buffers()[1], np.int32)[items.offset : items.offset + len(items) + 1]
    data = np.frombuffer(items.buffers()[2], np.uint8)
    codes = np.zeros((len(items), m + 1), np.uint8)
    codes[:, :m] = data[offsets[:-1, None] + np.arange(m, dtype=np.int32)]
    longer = np.flatnonzero(np.diff(offsets) > m)
    codes[longer, m] = data[offsets[longer] + m]
    return codes


def _pairs_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near words of the buckets of one (m, s, t, end): per word their number, and the most frequent one."""
    m, s, t, end = (table[c][0].as_py() for c in ("m", "s", "t", "end"))
    items = table["item"].combine_chunks()
    items = items.chunk(0) if isinstance(items, pa.ChunkedArray) else items
    codes = _codes(items, m)
    other = table["other"].to_numpy()
    new_bucket = np.append(True, other[1:] != other[:-1])
    words = SortedList(codes, max(s, t), new_bucket)
    n = table["n"].to_numpy()
    forward = codes
    if t > s:  # read backwards: turn round for the claim and for the order of the words
        forward = codes[:, ::-1]
        short = codes[:, m] == 0
        forward = np.where(short[:, None], np.roll(forward, -1, axis=1), forward)
    order = np.empty(len(n), np.int64)
    order[np.lexsort(forward.T[::-1])] = np.arange(len(n))
    queries = np.flatnonzero((codes[:, m] == 0) & (words.high - words.low > 1)).astype(np.int32)
    froms, tos = [], []
    for i in range(0, len(queries), QUERIES):
        q, w = words.near(queries[i : i + QUERIES])
        if end < m:  # the pairs whose common prefix ends further on are another bucket's
            mine = (forward[q, :end] != forward[w, :end]).any(axis=1)
            q, w = q[mine], w[mine]
        longer = codes[w, m] != 0  # words of m + 1 code points do not ask themselves
        froms += [q, w[longer]]
        tos += [w, q[longer]]
    if not froms:
        return
    a, b = np.concatenate(froms), np.concatenate(tos)
    if not len(a):
        return
    ranked = np.lexsort((order[b], -n[b], a))
    a, b = a[ranked], b[ranked]
    firsts = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    near = np.diff(np.append(firsts, len(a)))
    text = table["word"]
    out = [text.take(pa.array(a[firsts])), pa.array(near), pa.array(n[b[firsts]]), text.take(pa.array(b[firsts]))]
    out = pa.table(out, names=["word", "near", "best_n", "best"])
    yield from out.combine_chunks().to_batches()


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole buckets; a block ends where a bucket ends."""
    held, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows < BLOCK_ROWS and size < BLOCK_BYTES:
            continue
        table = pa.Table.from_batches(held)
        cut = _last_start(table)
        if cut:
            yield from _blocks(table.slice(0, cut))
            table = table.slice(cut)
        held, rows, size = table.combine_chunks().to_batches(), table.num_rows, table.nbytes
    if held:
        yield from _blocks(pa.Table.from_batches(held))


def _changes(table: pa.Table, columns: list[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows, bool)
    for c in columns:
        values = table[c].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return changed


def _last_start(table: pa.Table) -> int:
    """Row at which the last bucket begins."""
    starts = np.flatnonzero(_changes(table, ["m", "s", "t", "end", "lead", "other"]))
    return int(starts[-1]) if len(starts) else 0


def _blocks(table: pa.Table) -> Iterator[pa.RecordBatch]:
    edges = [0, *np.flatnonzero(_changes(table, ["m", "s", "t", "end"])).tolist(), table.num_rows]
    for i, j in zip(edges, edges[1:]):
        yield from _pairs_of(table.slice(i, j - i))


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, letters: int = BUCKET_LETTERS) -> DataFrame:
    """(word, n_near, form, form_n): number of near words, and the most frequent of them (ties: the first in order).

    ``words`` is a written table of distinct words and their n; words without a near word have no row. ``min_length`` is the
    least length of a word, and at least 2.
    """
    bounded_batches(words.sparkSession)
    rows = _fitting(words, min_length, letters)
    back = F.col("t") > F.col("s")
    rows = rows.select(
        "word", "n", "m", "s", "t", "end",
        F.encode(F.when(back, F.reverse("word")).otherwise(F.col("word")), "ISO-8859-1").alias("item"),
        F.expr("xxhash64(if(t > s, right(word, t), left(word, s)))").alias("lead"),
        F.expr("if(t > s, left(word, s), right(word, t))").alias("other"),
    )
    dealt = rows.repartition("m", "s", "t", "end", "lead", "other")
    found = dealt.sortWithinPartitions("m", "s", "t", "end", "other", "item").mapInArrow(_search, _ROW)
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    ).select("word", "n_near", F.col("b.best").alias("form"), (-F.col("b.n")).alias("form_n"))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. Each round doubles the steps; forms grow by a factor, so there are few."""
    done = as_derived_table(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = done.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = done.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        jumped = as_derived_table(jumped, "roots")
        done = jumped.select("word", "root")
        if jumped.where(F.col("next").isNotNull()).isEmpty():
            return done


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int = DAMAGE,
    ratio: int = RATIO, letters: int = BUCKET_LETTERS,
) -> DataFrame:
    """Words of all texts: word, form, root, n, n_near, form_n.

    The form is the most frequent near word if it is ``ratio`` times as frequent as the word, ties by code points; the root is where
    forms of forms end. Null and empty texts give no words, a table without words no rows; repeated rows count each time;
    a run of any length is a word; columns other than doc_id and text are not read.
    """
    words = as_derived_table(vocabulary(docs, min_length, min_count, damage), "vocabulary")
    rows = words.join(near_words(words, min_length, letters), "word", "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    rows = rows.select(
        "word", F.when(formed, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("form_n")).alias("form_n"),
    )
    rows = as_derived_table(rows, "variants")
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants_sql() -> str:
    """The same in DuckDB: crc32 by its table, near words by the words with one code point left out."""
    return f"""
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM (SELECT unnest(range(256)) AS i))),
        runs AS (
            SELECT id, translate(run, '{UPPER}', '{LOWER}') AS run
            FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                         unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}')) AS run FROM documents)),
        distinct_runs AS (SELECT id, run, count(*) AS times FROM runs GROUP BY ALL),
        hashed AS (
            SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
                    string_split(id || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)]
                        ELSE [192 + (CAST(ord(x) AS BIGINT) >> 6), 128 + (CAST(ord(x) AS BIGINT) & 63)] END))),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
            FROM distinct_runs, crc_table),
        words AS (
            SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
                SELECT times, CASE WHEN h % {DAMAGE} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                                   ELSE run END AS word FROM hashed)
            WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
        less AS (
            SELECT DISTINCT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n FROM less a JOIN less b
                ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON w.word = l.rest
            UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest),
        best AS (
            SELECT word, count(*) AS n_near, max(n) AS best_n FROM near GROUP BY word),
        formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {RATIO} * w.n THEN best_n END AS form_n,
                   (SELECT min(o.other) FROM near o WHERE o.word = w.word AND o.n = best_n AND best_n >= {RATIO} * w.n) AS form
            FROM words w LEFT JOIN best USING (word)),
        steps(word, root, next) AS (
            SELECT word, word, form FROM formed
            UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN formed f ON f.word = s.next)
        SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
        FROM formed f JOIN steps s ON s.word = f.word AND s.next IS NULL"""
