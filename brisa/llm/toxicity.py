"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel of two strings sums over all subsequences of three letters that both have, each weighed down by
the letters that it spans; it is scaled to 1 for equal strings. So an insult with letters set apart or put in
between stays close to the plain one. The kernel of two sentences is the sum over their units; a unit is a word without
what is no letter, or a run of single letters. A sentence is compared with some landmark strings, and the
Nyström map turns these values into features, on which a linear machine is trained with the labels of
sentences: the worst sentence of a toxic document is toxic, and so is that of another document not. A document's
worst sentence and the mean of all its units then give its probability.

A unit that lacks two or more of a landmark's different letters counts as unlike it (0) without a look at the kernel.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import bounded_batches, held_out, released, text_bytes

# About so many labelled documents of either label are learned from, chosen by a hash of their id.
TRAIN_DOCUMENTS = 1500
LANDMARKS = 72
LANDMARK_POOL = 1500  # units that the landmarks are chosen from
COVER = 3  # landmarks that each toxic document should have a unit close to
THRESHOLD = 0.3

ORDER = 3
DECAY = 0.75
SHARP = 3  # power of the kernel: likeness has to be close to count

SENTENCE_WORDS = 15
SINGLES = 3  # single letters in a row that make a unit
REMEMBERED = 600_000
END = re.compile(rb"[.!?]\W*$")
# Signs that stand for letters.
LOOKALIKES = str.maketrans("013457@$", "oieastas")


def unit_of(word: bytes) -> str:
    text = word.decode().lower()
    if text.isalpha():
        return text
    if any(map(str.isalpha, text)):
        text = text.rstrip("!?.,;:").translate(LOOKALIKES)
    return "".join(filter(str.isalpha, text))


def codes(units: list[str], width: int, blank: int) -> np.ndarray:
    """One row of code points per unit; ``blank`` fills up."""
    out = np.array(units, dtype=f"U{width}").view(np.uint32).reshape(len(units), width).astype(np.int64)
    out[out == 0] = blank
    return out


def raw_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequences of ORDER letters for rows of code points, pair by pair."""
    match = (s.T[:, None, :] == t.T[None, :, :]).astype(np.float32)
    match *= DECAY**2
    w = match
    for _ in range(ORDER - 1):
        d = np.zeros_like(w)
        # d[a, b]: all of w before a and b, weighed down by the distance
        for a in range(1, w.shape[0]):
            np.multiply(d[a - 1, 1:], DECAY, out=d[a, 1:])
            d[a, 1:] += w[a - 1, :-1]
        for b in range(2, w.shape[1]):
            d[:, b] += DECAY * d[:, b - 1]
        d *= match
        w = d
    return w.sum(axis=(0, 1), dtype=np.float64)


def self_kernel(units: list[str]) -> np.ndarray:
    width = max(map(len, units))
    return raw_kernel(codes(units, width, -1), codes(units, width, -2))


def letters(c: np.ndarray) -> np.ndarray:
    """The different letters of each row as bits."""
    bit = np.where(c >= 0, 1 << (c % 61), 0)
    return np.bitwise_or.reduce(bit, axis=1)


@dataclass
class Kernel:
    landmarks: list[str]
    own: np.ndarray = field(init=False)

    def __post_init__(self):
        self.width = max(map(len, self.landmarks), default=1)
        self.codes = codes(self.landmarks, self.width, -2)
        self.own = self_kernel(self.landmarks) if self.landmarks else np.zeros(0)
        self.letters = letters(codes(self.landmarks, self.width, -1)) if self.landmarks else np.zeros(0, dtype=np.int64)

    def __call__(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit, landmark and value of all pairs that are not 0."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lengths = np.array([len(u) for u in units])
        low = ORDER
        while self.landmarks and low <= lengths.max(initial=0):
            high = max(2 * low, 12)
            some = np.flatnonzero((lengths >= low) & (lengths < high))
            # long units in small groups, so that the table of a group stays small
            step = max(1, 250_000 // (high * self.width))
            for at in range(0, len(some), 20_000):
                part = some[at : at + 20_000]
                own_codes = codes([units[i] for i in part], int(lengths[part].max()), -1)
                shared = np.bitwise_count(letters(own_codes)[:, None] & self.letters[None, :])
                u, m = np.nonzero(shared >= np.maximum(np.bitwise_count(self.letters) - 1, 2)[None, :])
                for k in range(0, len(u), step):
                    x, y = u[k : k + step], m[k : k + step]
                    value = raw_kernel(own_codes[x], self.codes[y])
                    used = value > 0
                    x, y, value = x[used], y[used], value[used]
                    if len(x):
                        mine, back = np.unique(x, return_inverse=True)
                        c = own_codes[mine]
                        other = np.where(c < 0, -2, c)
                        norm = raw_kernel(c, other)[back] * self.own[y]
                        found.append((part[x], y, (value / np.sqrt(norm)) ** SHARP))
            low = high
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


LEAST = 0.15  # values below count as 0


class Reader:
    """Sentences of texts as values per landmark. Words are looked up once and remembered."""

    def __init__(self, kernel: Kernel):
        self.kernel = kernel
        self.word: dict[bytes, int] = {}  # 2 * entry + (ends a sentence); entry 0: like no landmark
        self.values: list[dict[int, float]] = [{}]
        self.single: list[str] = [""]
        self.runs: dict[str, dict[int, float]] = {}

    def learn(self, new: list[bytes]) -> None:
        units = [unit_of(w) for w in new]
        near: dict[int, dict[int, float]] = {}
        for u, m, v in zip(*(x.tolist() for x in self.kernel(units)), strict=True):
            if v >= LEAST:
                near.setdefault(u, {})[m] = v
        for i, (word, unit) in enumerate(zip(new, units, strict=True)):
            entry = 0
            if i in near or len(unit) == 1:
                entry = len(self.values)
                self.values.append(near.get(i, {}))
                self.single.append(unit if len(unit) == 1 else "")
            self.word[word] = 2 * entry + bool(END.search(word))

    def learn_all(self, texts: list[bytes]) -> list[list[bytes]]:
        cut = [t.split() for t in texts]
        new = set().union(*cut).difference(self.word)
        if len(self.word) + len(new) > REMEMBERED:
            self.__init__(self.kernel)
            new = set().union(*cut)
        if new:
            self.learn(list(new))
        return cut

    def run(self, unit: str) -> dict[int, float]:
        if unit not in self.runs:
            if len(self.runs) > 10_000:
                self.runs.clear()
            _, m, v = self.kernel([unit])
            self.runs[unit] = {a: b for a, b in zip(m.tolist(), v.tolist(), strict=True) if b >= LEAST}
        return self.runs[unit]

    def sentences(self, words: list[bytes]) -> list[dict[int, float]]:
        """The sentences that are like some landmark: the sum of their units for each landmark."""
        found = np.fromiter(map(self.word.__getitem__, words), dtype=np.int64, count=len(words))
        at = np.flatnonzero(found >= 2)
        if not len(at):
            return []
        number = np.cumsum(found & 1) - (found & 1)
        out: dict[int, dict[int, float]] = {}

        def add(sentence: int, values: dict[int, float]) -> None:
            mine = out.setdefault(sentence, {})
            for m, v in values.items():
                mine[m] = mine.get(m, 0.0) + v

        run, last = "", -2
        for i, entry in zip(at.tolist(), (found[at] >> 1).tolist(), strict=True):
            if self.values[entry]:
                add(int(number[i]), self.values[entry])
            letter = self.single[entry]
            if run and (not letter or i != last + 1):
                if len(run) >= SINGLES:
                    add(int(number[last]), self.run(run))
                run = ""
            if letter:
                run, last = run + letter, i
        if len(run) >= SINGLES:
            add(int(number[last]), self.run(run))
        return [s for s in out.values() if s]


@dataclass
class Model:
    landmarks: list[str]
    weights: list[float]  # on the kernel values, the Nyström map multiplied in
    bias: float
    curve: list[float]  # of the probability: worst sentence, mean, constant

    def values(self, sentences: list[dict[int, float]], words: int) -> tuple[float, float]:
        """Margin of the worst sentence; the mean of a unit times that of a usual sentence's length."""
        sums = [sum(self.weights[m] * v for m, v in s.items()) for s in sentences]
        return self.bias + max([0.0, *sums]), SENTENCE_WORDS * sum(sums) / max(words, SENTENCE_WORDS)

    def probability(self, worst: float, mean: float) -> float:
        a, b, c = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * worst + b * mean + c, -500, 500))))


def _sample(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[DataFrame, dict[int, float]]:
    """doc_id, toxic of the rows to learn from, and the part of each label that they are."""
    rows = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = {label: min(1.0, per_label / count) for label, count in n.items()}
    limit = F.when(F.col("toxic") == 1, part.get(1, 0.0)).otherwise(part.get(0, 0.0)) * (1 << 30)
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < limit), part


def choose_landmarks(texts: DataFrame, n: dict[int, int]) -> list[str]:
    """Units of toxic documents, chosen so that as many of these as possible have some unit close to a landmark.

    Only units that are much more common in toxic documents than in others are chosen from.
    """
    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = sorted({u for w in set(text.split()) if len(u := unit_of(w)) >= ORDER})
                yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(found), pa.int32()), pa.array(found, pa.string())], ["toxic", "unit"])

    counted = texts.select("toxic", "text").mapInArrow(units, "toxic int, unit string").groupBy("unit").agg(
        F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all")
    )
    bad, good = F.col("bad"), F.col("all") - F.col("bad")
    odds = ((bad + 0.5) / (n[1] + 1)) / ((good + 0.5) / (n[0] + 1))
    telling = counted.where((bad >= 3) & (odds >= 4)).orderBy((bad * F.log(odds)).desc(), "unit").limit(LANDMARK_POOL)
    pool = [r["unit"] for r in telling.collect()]
    if not pool:
        return []
    place = {u: i for i, u in enumerate(pool)}

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            rows = [sorted({place[u] for w in set(t.split()) if (u := unit_of(w)) in place}) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["units"])

    toxic = texts.where("toxic = 1").select("text").mapInArrow(members, "units array<int>")
    close: list[set[int]] = [{i} for i in range(len(pool))]
    for u, m, v in zip(*(x.tolist() for x in Kernel(pool)(pool)), strict=True):
        if v >= LEAST:
            close[u].add(m)
            close[m].add(u)
    documents: list[set[int]] = [set() for _ in pool]  # that a landmark would cover
    for d, row in enumerate(sorted(list(r["units"]) for r in toxic.collect())):
        for u in set().union(*(close[u] for u in row)):
            documents[u].add(d)
    covered: dict[int, int] = {}
    chosen: list[int] = []
    while len(chosen) < min(LANDMARKS, len(pool)):
        gain, best = max((sum(covered.get(d, 0) < COVER for d in documents[i]), -i) for i in range(len(pool)) if i not in chosen)
        if gain < 3:
            break
        chosen.append(-best)
        for d in documents[-best]:
            covered[d] = covered.get(d, 0) + 1
    return [pool[i] for i in chosen]


def _sentences(texts: DataFrame, landmarks: list[str]) -> list[tuple[int, int, list[dict[int, float]]]]:
    """Label, words and kernel values of the sentences of each document that was sampled."""
    kernel = Kernel(landmarks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(kernel)
        for batch in released(batches):
            marks, values, n = [], [], []
            for words in reader.learn_all(batch.column(1).to_pylist()):
                found = reader.sentences(words)
                n.append(len(words))
                marks.append([list(s) for s in found])
                values.append([list(s.values()) for s in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(marks, pa.list_(pa.list_(pa.int32()))), pa.array(values, pa.list_(pa.list_(pa.float64())))],
                ["toxic", "words", "marks", "values"],
            )

    rows = texts.select("toxic", "text").mapInArrow(run, "toxic int, words long, marks array<array<int>>, values array<array<double>>")
    out = [
        (r["toxic"], r["words"], [dict(zip(m, v, strict=True)) for m, v in zip(r["marks"], r["values"], strict=True)])
        for r in rows.collect()
    ]
    return sorted(out, key=str)


def nystrom(landmarks: list[str]) -> np.ndarray:
    """Inverse square root of the landmarks' kernel matrix, small eigenvalues raised."""
    u, m, v = Kernel(landmarks)(landmarks)
    k = np.eye(len(landmarks))
    k[u, m] = v
    k = (k + k.T) / 2
    values, vectors = np.linalg.eigh(k)
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.1))) @ vectors.T


def fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, strength: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by full gradient steps; the same input gives the same result."""
    w, b = np.zeros(x.shape[1]), 0.0
    total = cost.sum()
    rate = 1.0 / (2 * (x * x).sum(axis=1).max(initial=1.0) + 2 + strength)
    vw, vb = w, b
    for k in range(steps):
        lack = np.maximum(0, 1 - y * (x @ vw + vb)) * cost * y
        new_w = vw + rate * (2 * (x.T @ lack) / total - strength * vw)
        new_b = vb + rate * 2 * lack.sum() / total
        push = k / (k + 3)
        vw, vb = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    return w, float(b)


def fit_probability(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Logistic curve through the rows of ``x`` by Newton steps; its constant comes last."""
    x = np.c_[x, np.ones(len(x))]
    a = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        h = weight * p * (1 - p) + 1e-9
        a = a - np.linalg.solve((x.T * h) @ x + ridge, x.T @ (weight * (p - y)) + ridge @ a)
    return a.tolist()


def train(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCUMENTS) -> Model:
    """Learns from labelled rows that are not held out.

    Without both labels, or without a unit that tells them apart, every document gets the share of toxic rows.
    """
    bounded_batches(docs.sparkSession)
    sample, part = _sample(docs, labels, per_label)
    # a few thousand ids at most
    texts = docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(sample), "doc_id").select("toxic", "text")
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = {label: n.get(label, 0) / p for label, p in part.items()}
    share = weight.get(1, 0.0) / max(sum(weight.values()), 1.0)
    flat = Model([], [], 0.0, [0.0, 0.0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))])
    if not n.get(0) or not n.get(1):
        return flat
    landmarks = choose_landmarks(texts, n)
    if not landmarks:
        return flat
    documents = _sentences(texts, landmarks)
    root = nystrom(landmarks)

    def features(sentences: list[dict[int, float]]) -> np.ndarray:
        x = np.zeros((len(sentences), len(landmarks)))
        for i, s in enumerate(sentences):
            x[i, list(s)] = list(s.values())
        return x @ root

    y = np.array([toxic for toxic, _, _ in documents])
    each = [features([*s, {}]) for _, _, s in documents]  # the sentences that are like nothing count as one
    worst = [int(np.argmax((x * x).sum(axis=1))) for x in each]
    w, b = np.zeros(len(landmarks)), 0.0
    for _ in range(4):
        rows = np.array([x[i] for x, i in zip(each, worst, strict=True)])
        cost = np.where(y == 1, 0.5 / max(1, n[1]), 0.5 / max(1, n[0])) * len(y)
        w, b = fit_svm(rows, 2.0 * y - 1, cost)
        worst = [int(np.argmax(x @ w)) for x in each]
    model = Model(landmarks, (root @ w).tolist(), b, [])
    seen = np.array([model.values(s, words) for _, words, s in documents])
    model.curve = fit_probability(seen, y, np.array([1 / part[int(t)] for t in y]))
    return model


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and ``__score`` of the whole text; null counts as empty."""
    bounded_batches(docs.sparkSession)
    kernel = Kernel(model.landmarks)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(kernel)
        for batch in released(batches):
            out, texts = [], batch.tolist()
            for at in range(0, len(texts), 200):
                for words in reader.learn_all(texts[at : at + 200]):
                    out.append(model.probability(*model.values(reader.sentences(words), len(words))))
            yield pd.Series(out, dtype="float64")

    return docs.withColumn("__score", F.pandas_udf(score, "double")(text_bytes()))


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels))
    return rows.select(
        "doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
        F.when(F.col("__score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
