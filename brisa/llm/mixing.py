"""Mixing sources to target weights by a min-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern (the set of sources), so
that the flow problem has one node per pattern and one per source, whatever the number of documents. A
pattern offers its words once, twice, ... up to a largest number of repeats; each further round costs more
(convex), so that a cheapest flow repeats as little as it can. Every source draws its target. Augmenting
along shortest paths solves it exactly. A pattern's flow then becomes documents: whole rounds of all of them
plus a seeded selection for the last, partial round.

The driver holds the flow network only: patterns and sources, never documents.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.llm.common import WORD, as_derived_table, small_table, text_or_empty
from brisa.session import as_written_table

# Fixed values of the standard mix.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20240501

# Largest network that the driver solves; beyond it the operator stops with an error.
MAX_PATTERNS = 100_000

# The selection of the last round looks at about so many documents of a pattern at once.
SELECT_ROWS = 2000
RADIX_BITS = 8

Pattern = tuple  # sorted sources, None last


def by_code_point(source: str | None) -> tuple:
    return (source is None, source or "")


def standard_targets(sizes: Mapping[str | None, int]) -> dict[str | None, float]:
    """Shares of all words by weights 5, 2, 1, repeating over the sources in order, null last.

    A target stops at three times the size of its source; what is above is shared again by weight among the
    others, until no target is above. Exact fractions, rounded once at the end.
    """
    sources = sorted(sizes, key=by_code_point)
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(sources)}
    target: dict[str | None, Fraction] = {}
    open_sources, left = list(sources), Fraction(sum(sizes.values()))
    while open_sources:
        total = sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if left * weight[s] / total > MAX_REPEATS * sizes[s]]
        if not full:
            target.update({s: left * weight[s] / total for s in open_sources})
            break
        for s in full:
            target[s] = Fraction(MAX_REPEATS * sizes[s])
            left -= target[s]
        open_sources = [s for s in open_sources if s not in target]
    return {s: float(target[s]) for s in sources}


def route(
    capacity: Mapping[Pattern, int], quota: Mapping[str | None, int], max_repeats: int = MAX_REPEATS
) -> dict[Pattern, int]:
    """Words that each pattern gives, repeats counted: the cheapest way to fill the quotas.

    Arcs: start -> pattern, one per round with the pattern's words as capacity and the round's number as
    cost; pattern -> each of its sources, free; source -> end, its quota. Shortest augmenting paths with
    potentials; each path moves as much as its narrowest arc takes. Quotas that cannot be filled stay partly
    empty (a maximum flow).
    """
    heads: list[int] = []
    room: list[int] = []
    cost: list[int] = []
    arcs: dict[int, list[int]] = defaultdict(list)

    def arc(a: int, b: int, size: int, price: int) -> None:
        for u, v, c, p in ((a, b, size, price), (b, a, 0, -price)):
            arcs[u].append(len(heads))
            heads.append(v)
            room.append(c)
            cost.append(p)

    patterns = sorted(capacity, key=lambda p: [by_code_point(s) for s in p])
    sources = sorted(quota, key=by_code_point)
    start, end = 0, 1
    node = {s: 2 + i for i, s in enumerate(sources)}
    rounds: dict[Pattern, list[int]] = {}
    for i, p in enumerate(patterns):
        at = 2 + len(sources) + i
        rounds[p] = []
        for k in range(max_repeats):
            rounds[p].append(len(heads))
            arc(start, at, capacity[p], k)
        for s in p:
            arc(at, node[s], capacity[p] * max_repeats, 0)
    for s in sources:
        arc(node[s], end, quota[s], 0)

    potential: dict[int, int] = defaultdict(int)
    while True:
        best, via, heap = {start: 0}, {}, [(0, start)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > best[u]:
                continue
            for e in arcs[u]:
                if room[e]:
                    v, new = heads[e], d + cost[e] + potential[u] - potential[heads[e]]
                    if v not in best or new < best[v]:
                        best[v], via[v] = new, e
                        heapq.heappush(heap, (new, v))
        if end not in best:
            break
        far = max(best.values())
        for u in range(2 + len(sources) + len(patterns)):
            potential[u] += best.get(u, far)
        path, u = [], end
        while u != start:
            path.append(via[u])
            u = heads[via[u] ^ 1]
        moved = min(room[e] for e in path)
        for e in path:
            room[e] -= moved
            room[e ^ 1] += moved
    return {p: sum(room[e ^ 1] for e in rounds[p]) for p in patterns}


def mix(
    docs: DataFrame,
    members: str,
    size: str,
    targets=standard_targets,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Adds ``repeats`` (how often the mix takes a row), ``pattern_size`` and nothing else.

    ``members`` is an array column with the sources of a row (a null element is a source of its own; a null
    or empty array belongs nowhere and is not taken); ``size`` a count of words (null counts as 0). ``targets``
    maps the sizes of the sources (a row counts in each of its sources) to their targets. Rows that agree in
    all their columns but the ``carried`` ones are taken alike. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    names = docs.columns
    slim = docs.select(
        "*",
        F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>")))).alias("__pattern"),
        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("__size"),
        F.xxhash64(F.lit(seed), *[n for n in names if n not in carried]).alias("__key"),
    )
    slim = as_written_table(slim, "mix")
    # null is lost as a key of a text, so a pattern is told apart by its own JSON text
    label = F.to_json(F.struct(F.col("__pattern").alias("p")), {"ignoreNullFields": "false"})
    slim = slim.withColumn("__label", label)
    found = slim.groupBy("__label").agg(
        F.first("__pattern").alias("p"), F.sum("__size").alias("n"), F.count(F.lit(1)).alias("rows")
    )
    patterns = found.limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    capacity, of_label, rows_of = {}, {}, {}
    for r in patterns:
        p = tuple(sorted(r["p"], key=by_code_point))
        of_label[r["__label"]], capacity[p], rows_of[r["__label"]] = p, r["n"], r["rows"]
    sizes: dict[str | None, int] = defaultdict(int)
    for p, n in capacity.items():
        for s in p:
            sizes[s] += n
    wanted = targets(sizes)
    flow = route(capacity, {s: round(t) for s, t in wanted.items()}, max_repeats)

    schema = T.StructType([
        T.StructField("__label", T.StringType()), T.StructField("__whole", T.IntegerType()),
        T.StructField("__part", T.LongType()), T.StructField("__rows", T.LongType()),
        T.StructField("pattern_size", T.LongType()),
    ])
    plan = []
    for text, p in of_label.items():
        n = capacity[p]
        whole, part = divmod(flow[p], n) if n else (0, 0)
        plan.append((text, whole, part, rows_of[text], n))
    rounds = small_table(spark, plan, schema)
    joined = slim.join(rounds, "__label")
    chosen = _last_round(joined.where("__part > 0").select("__label", "__key", "__size", "__part", "__rows"))
    taken = chosen.select("__label", "__key", F.lit(1).alias("__extra"))
    return joined.join(taken, ["__label", "__key"], "left").select(
        *names, (F.col("__whole") + F.coalesce("__extra", F.lit(0))).alias("repeats"), "pattern_size"
    )


def _last_round(rows: DataFrame) -> DataFrame:
    """Keys of the rows that fill ``__part`` words of each pattern, until no row that is left fits in what is open.

    A pass may end at a few rows that are too long, although others would fit. The next one sees the rows not taken that
    are no longer than its pattern's open words, so each pass takes at least one row of every pattern that has any.
    """
    keys = rows.groupBy("__label", "__key").agg(
        F.sum("__size").alias("__size"), F.first("__part").alias("__part"), F.first("__rows").alias("__rows")
    )
    keys = as_derived_table(keys, "mix-keys")
    out: DataFrame | None = None
    while True:
        taken = as_derived_table(_pass(keys), "mix-taken")
        out = taken if out is None else out.unionByName(taken)
        marked = keys.join(taken.withColumn("__in", F.lit(True)), ["__label", "__key"], "left")
        words = F.sum(F.when(F.col("__in"), F.col("__size")).otherwise(0))
        gaps = marked.groupBy("__label").agg((F.first("__part") - words).alias("__gap"))
        gaps = as_derived_table(gaps.where("__gap > 0"), "mix-gaps")
        fits = marked.where("__in IS NULL AND __size > 0").join(gaps, "__label").where("__size <= __gap")
        fits = as_derived_table(fits.select("__label", "__key", "__size", F.col("__gap").alias("__part")), "mix-keys")
        if fits.isEmpty():
            return out
        counts = as_derived_table(fits.groupBy("__label").agg(F.count(F.lit(1)).alias("__rows")), "mix-counts")
        keys = as_derived_table(fits.join(counts, "__label"), "mix-keys")


def _pass(keys: DataFrame) -> DataFrame:
    """Keys of rows that fill at most ``__part`` words of each pattern, in the order of the seeded key.

    The key is read as digits. Level by level the digit is found at which the words run out; all rows below
    are taken, those of that digit go on until a pattern has few rows left, of which some are taken to fit. Only the sums per digit are compared, 256 of a pattern at most, and every row is read once
    per level, so no task sees a whole pattern.
    """
    unsigned = F.col("__key")
    out: DataFrame | None = None
    shift = 64
    while True:
        few = keys.where(F.col("__rows") <= SELECT_ROWS)
        many = keys.where(F.col("__rows") > SELECT_ROWS)
        fitted = few.groupBy("__label").applyInPandas(_fill, "__label string, __key long")
        out = fitted if out is None else out.unionByName(fitted)
        if shift == 0 or many.isEmpty():
            break
        shift -= RADIX_BITS
        digit = F.shiftrightunsigned(unsigned, shift).bitwiseAND(F.lit((1 << RADIX_BITS) - 1))
        many = many.withColumn("__digit", digit)
        sums = many.groupBy("__label", "__digit").agg(
            F.sum("__size").alias("n"), F.count(F.lit(1)).alias("rows"), F.first("__part").alias("part")
        )
        steps = sums.groupBy("__label", "part").agg(F.array_sort(F.collect_list(F.struct("__digit", "n", "rows"))).alias("d"))
        below = F.aggregate(
            "d",
            F.struct(
                F.lit(-1).cast("long").alias("at"), F.col("part").alias("left"),
                F.lit(0).cast("long").alias("rows"), F.lit(True).alias("open"),
            ),
            lambda a, x: F.when(
                a["open"] & (x["n"] <= a["left"]),
                F.struct(a["at"].alias("at"), (a["left"] - x["n"]).alias("left"), a["rows"].alias("rows"), F.lit(True).alias("open")),
            )
            .when(
                a["open"],
                F.struct(x["__digit"].cast("long").alias("at"), a["left"].alias("left"), x["rows"].alias("rows"), F.lit(False).alias("open")),
            )
            .otherwise(a),
        )
        cut = steps.select("__label", below.alias("c"))
        at = many.join(cut, "__label")
        out = out.unionByName(
            at.where(F.col("c.open") | (F.col("__digit") < F.col("c.at"))).select("__label", "__key")
        )
        keys = as_derived_table(
            at.where(~F.col("c.open") & (F.col("__digit") == F.col("c.at"))).select(
                "__label", "__key", "__size", F.col("c.left").alias("__part"), F.col("c.rows").alias("__rows")
            ),
            "mix-keys",
        )
    return out


def _fill(rows):
    """Rows of one pattern, at most a few thousand: in the order of the key up to most of the words, then, of the
    others that fit, always the largest, so that the small ones close the gap."""
    rows = rows.sort_values("__key")
    left = int(rows["__part"].iloc[0])
    last = left // 5
    items = list(zip(rows["__key"].tolist(), rows["__size"].tolist(), strict=True))
    at = 0
    chosen = set()
    while at < len(items) and left - items[at][1] >= last:
        left -= items[at][1]
        chosen.add(items[at][0])
        at += 1
    for key, size in sorted(items[at:], key=lambda x: (-x[1], x[0])):
        if size <= left:
            left -= size
            chosen.add(key)
    return rows[rows["__key"].isin(chosen)][["__label", "__key"]]


def sized(docs: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    return docs.select(*carried, "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(text_or_empty()).alias("text_hash"))


def standard_mix(docs: DataFrame, seed: int = SEED, carried: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row; ``source`` is its only source, null one of its own."""
    rows = sized(docs, carried).withColumn("members", F.array("source"))
    kept: dict[str | None, float] = {}

    def targets(sizes):
        kept.update(standard_targets(sizes))
        return kept

    mixed = mix(rows, "members", "size", targets, MAX_REPEATS, seed, carried)
    schema = T.StructType([T.StructField("__source", T.StringType()), T.StructField("target", T.DoubleType())])
    goal = small_table(docs.sparkSession, list(kept.items()), schema)
    return mixed.join(goal, F.col("source").eqNullSafe(F.col("__source"))).select(
        *carried, "doc_id", "size", F.col("pattern_size").alias("source_size"), "target",
        (F.col("size") * F.col("repeats")).cast("long").alias("taken"), F.col("repeats").cast("int").alias("repeats"),
    )
