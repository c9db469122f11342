"""Quality rules as a short-circuit cascade.

A bounded sample, spread over the files of the table, tells what each rule costs (seconds for the measures that it needs beyond
those taken before) and how much it rejects of what the rules before it let pass. The rules
then run in the order of rejection per cost, and a document leaves at the first rule that
rejects it, so that dear measures are taken only of documents that the cheap rules let pass. The verdict is the same
in any order; only the time differs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import bounded_batches, text_bytes

# Documents that the order of the rules is estimated from. The verdicts do not depend on it.
SAMPLE_ROWS = 300
SAMPLE_FILES = 10
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"


class Measures:
    """Counts over one whole text, each taken when it is first asked for."""

    def __init__(self, data: bytes):
        self.data = data

    def __getattr__(self, name: str):
        value = getattr(self, f"_{name}")()
        setattr(self, name, value)
        return value

    def _words(self) -> list[bytes]:
        return self.data.split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        """Code points in words: bytes that do not continue a character and are no white space."""
        codes = np.frombuffer(self.data, dtype=np.uint8)
        white = sum(self.data.count(w) for w in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        return int(np.count_nonzero((codes & 0xC0) != 0x80)) - white

    def _n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    def _n_dup_lines(self) -> int:
        lines = [x for x in self.data.split(b"\n") if x.strip(WHITE)]
        return len(lines) - len(set(lines))

    def _n_lines(self) -> int:
        return sum(1 for x in self.data.split(b"\n") if x.strip(WHITE))

    def _n_repeat_words(self) -> int:
        """Words in windows of five that the text has twice or more. Words are numbered, so that equal windows are equal numbers."""
        words = self.words
        n = len(words) - WINDOW + 1
        if n < 2:
            return 0
        number: dict[bytes, int] = {}
        codes = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        base = len(number)
        window, limit = codes[:n], base
        for j in range(1, WINDOW):
            if limit * base >= 2**62:
                window = np.unique(window, return_inverse=True)[1]
                limit = n
            window = window * base + codes[j : j + n]
            limit *= base
        _, place, counts = np.unique(window, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[place] > 1)
        if not len(starts):
            return 0
        covered = np.zeros(len(words), dtype=bool)
        for j in range(WINDOW):
            covered[starts + j] = True
        return int(np.count_nonzero(covered))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


# Fixed values of the standard rules; the first two are the base.
BASE = [
    Rule("few_words", lambda m: m.n_words < 10),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
]
STANDARD = [
    *BASE,
    Rule("short_words", lambda m: m.word_chars < 2 * m.n_words),
    Rule("long_words", lambda m: m.word_chars > 20 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 50 * m.n_lines),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def spread_rows(docs: DataFrame, rows: int, files: int = SAMPLE_FILES) -> DataFrame:
    """At most so many rows: the first of each of some files, evenly spaced in the order of the table's files.

    No other file is read. Of a table that is no scan of files these are its first rows.
    """
    names = sorted({path.rsplit("/", 1)[-1] for path in docs.inputFiles()})
    chosen = sorted({names[i * len(names) // files] for i in range(files)}) if names else []
    if "_metadata" in docs.columns or len(chosen) < 2:
        return docs.limit(rows)
    each = -(-rows // len(chosen))
    try:
        parts = [docs.where(F.col("_metadata.file_name") == name).limit(each) for name in chosen]
    except AnalysisException:  # derived from files, but no scan
        return docs.limit(rows)
    return reduce(DataFrame.unionAll, parts).limit(rows)


def greedy_order(rules: Sequence[Rule], rejected: np.ndarray, seconds: np.ndarray) -> list[Rule]:
    """Rules by rejections per second, the next always measured on the rows that are still in after those before it.

    ``rejected`` and ``seconds`` have a line per sampled row and a column per rule. Ties keep the given order.
    """
    left, order = list(range(len(rules))), []
    still = np.ones(len(rejected), dtype=bool)
    while left:
        gain = [(rejected[still, i].sum() / max(seconds[still, i].sum(), 1e-9), -seconds[:, i].sum()) for i in left]
        best = left.pop(max(range(len(left)), key=gain.__getitem__))
        order.append(rules[best])
        still &= ~rejected[:, best]
    return order


def ordered(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules in the order that a sample of the table suggests, each rule tried on a fresh text.

    The rules are tried where the rows are: the driver gets a flag and a time for each rule and sampled row, never a text.
    """

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, spent = [], []
            for text in batch.column(0).to_pylist():
                times, found = [], []
                for rule in rules:
                    began = time.perf_counter()
                    found.append(bool(rule.rejects(Measures(text))))
                    times.append(time.perf_counter() - began)
                hits.append(found)
                spent.append(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hits, pa.list_(pa.bool_())), pa.array(spent, pa.list_(pa.float64()))], ["rejected", "seconds"]
            )

    sample = spread_rows(docs, sample_rows).select(text_bytes().alias("text"))
    rows = sample.mapInArrow(tried, "rejected array<boolean>, seconds array<double>").collect()
    shape = (len(rows), len(rules))
    rejected = np.array([r["rejected"] for r in rows], dtype=bool).reshape(shape)
    return greedy_order(rules, rejected, np.array([r["seconds"] for r in rows], dtype=float).reshape(shape))


def cascade(docs: DataFrame, rules: Sequence[Rule] = STANDARD, counts: Sequence[str] = (), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the ``counts`` asked for, base_failed and kept of every row, from its whole text.

    A document is kept if no rule rejects it. Counts are taken after the verdict where the rules left them
    open. Null and empty texts have no words: they fail the base. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    order = ordered(docs, rules, sample_rows)
    counts = list(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in counts]
            base, kept = [], []
            for text in batch.column(1).to_pylist():
                m = Measures(text)
                kept.append(not any(rule.rejects(m) for rule in order))
                for column, name in zip(columns, counts, strict=True):
                    column.append(getattr(m, name))
                base.append(not kept[-1] and any(rule.rejects(m) for rule in BASE))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns], pa.array(base, pa.bool_()), pa.array(kept, pa.bool_())],
                ["doc_id", *counts, "base_failed", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in counts], "base_failed boolean", "kept boolean"])
    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, schema)
