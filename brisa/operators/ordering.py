"""Sorting, top-k, and the two rules that need an order per key or in total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.session import as_written_table
from pyspark.sql import Window


def _order(spec: str | Column, nulls_high: bool) -> Column:
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return (F.desc_nulls_first if nulls_high else F.desc_nulls_last)(spec[1:])
    return (F.asc_nulls_last if nulls_high else F.asc_nulls_first)(spec)


def sort_multi(df: DataFrame, *specs: str | Column, nulls_high: bool = True) -> DataFrame:
    """``"x"`` sorts ascending and ``"-x"`` descending.

    NULL counts as the largest value, or with ``nulls_high=False`` as the smallest.
    """
    return df.orderBy(*[_order(s, nulls_high) for s in specs])


def with_position(df: DataFrame, *specs: str | Column, name: str = "position", nulls_high: bool = True) -> DataFrame:
    """Numbers the rows from 1 in the given order, without bringing them into one task.

    The sorted rows are written with the number of their task and their place in it; the tasks' sizes, one row each, give the
    offset of every task. The order should have no ties, or a rerun may number these otherwise.
    """
    place = F.monotonically_increasing_id()
    bits = 33  # of the place within the task, below the number of the task
    placed = sort_multi(df, *specs, nulls_high=nulls_high).withColumn("_place", place)
    placed = as_written_table(placed.withColumn("_task", F.shiftright("_place", bits)), "sorted")
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = as_written_table(sizes.select("_task", F.coalesce(before, F.lit(0)).alias("_before")), "offsets")
    inside = F.col("_place").bitwiseAND(2**bits - 1)
    return placed.join(offsets, "_task").withColumn(name, F.col("_before") + inside + 1).select(*df.columns, name)


def topk(df: DataFrame, k: int, *specs: str | Column, nulls_high: bool = True) -> DataFrame:
    """First k rows by the given order; all columns break ties, so that it repeats."""
    named = {s.lstrip("-") for s in specs if isinstance(s, str)}
    ties = [c for c in df.columns if c not in named]
    return sort_multi(df, *specs, *ties, nulls_high=nulls_high).limit(k)


def limit_sample(df: DataFrame, n: int) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def latest_per_key(df: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Last record per key in arrival order.

    As only the first rank is kept, the planner limits every key to one row per task
    before the shuffle (WindowGroupLimit): a key with a third of all rows stays cheap.
    A row with NULL in the key equals no other row and is kept.
    """
    newest_first = Window.partitionBy(*key, "_null_key").orderBy(*[F.desc(c) for c in seq])
    ranked = with_null_key_id(df, key).withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).select(*df.columns)


def with_null_key_id(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Adds ``_null_key``: unique for rows with NULL in the key, NULL for all others."""
    some_null = F.lit(False)
    for c in key:
        some_null = some_null | F.col(c).isNull()
    return df.withColumn("_null_key", F.when(some_null, F.monotonically_increasing_id()))


def budget_cutoff(df: DataFrame, group: str, budget: int) -> DataFrame:
    """Whole groups in ascending order until the running total reaches the budget.

    The group that crosses the budget is kept whole. The total is found on two levels: the groups' counts are written in ranges of the
    group, the sums per range show in which one the budget is reached, and only this one is added up row by row.
    """
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange(group).withColumn("_range", F.spark_partition_id())
    ranged = as_written_table(ranged, "group-counts")
    before, crossing = 0, None
    for number, rows in sorted(ranged.groupBy("_range").agg(F.sum("_n")).collect()):
        if before >= budget:
            break
        crossing, offset = number, before
        before += rows
    if crossing is None:
        return df.where(F.lit(False))
    running = F.sum("_n").over(
        Window.partitionBy("_range").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = ranged.where(F.col("_range") == crossing).withColumn("_before", F.lit(offset) + F.coalesce(running, F.lit(0)))
    return df.where(F.col(group) <= F.lit(inside.where(F.col("_before") < budget).agg(F.max(group)).first()[0]))
