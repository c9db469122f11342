"""Aggregate columns for ``df.groupBy(*keys).agg(...)``, and ordered text lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def agg_count() -> Column:
    return F.count(F.lit(1))


def agg_count_col(col: str) -> Column:
    return F.count(col)


# Column of a table whose equal rows were combined: how many rows each stands for.
ROWS = "row_count"


def combined_rows(df: DataFrame, keys: Sequence[str], span: str | None = None) -> DataFrame:
    """Equal rows as one with their number, before any dimension is joined to them.

    ``span`` names a time column that is no key; of it the smallest value is kept under its name and the largest
    as ``last_<name>``. Reports with ``agg_rows`` give the same on the combined rows as on the rows themselves.
    """
    aggs = [F.count(F.lit(1)).alias(ROWS)]
    if span:
        aggs += [F.min(span).alias(span), F.max(span).alias(f"last_{span}")]
    return df.groupBy(*keys).agg(*aggs)


def combined_sides(df: DataFrame, sides: Sequence[str], span: str | None = None) -> DataFrame:
    """One row per value of each column in ``sides`` alone, from one pass: never one per pair.

    The rows are counted on the first side, those of the others stand for none. So totals, and distinct counts of columns that
    hang on one side each, are those of all rows; a report that groups by a column, or counts pairs, needs ``combined_rows``.
    """
    first = F.grouping_id() == 2 ** (len(sides) - 1) - 1
    aggs = [F.when(first, F.count(F.lit(1))).otherwise(0).cast("bigint").alias(ROWS)]
    if span:
        aggs += [F.min(span).alias(span), F.max(span).alias(f"last_{span}")]
    return df.groupingSets([[F.col(c)] for c in sides], *sides).agg(*aggs)


def agg_rows(df: DataFrame, where: Column | None = None) -> Column:
    """Number of rows, or of those that meet a condition; combined rows count as many as they stand for."""
    if ROWS not in df.columns:
        return agg_count() if where is None else F.count_if(where)
    n = F.col(ROWS) if where is None else F.when(where, F.col(ROWS))
    return F.coalesce(F.sum(n), F.lit(0).cast("bigint"))


def agg_avg_rows(df: DataFrame, col: str, digits: int) -> Column:
    """Rounded mean of a DECIMAL column over all rows that combined rows stand for."""
    if ROWS not in df.columns:
        return agg_avg_round(col, digits)
    n = F.when(F.col(col).isNotNull(), F.col(ROWS))
    total = F.sum(F.col(col) * F.col(ROWS)).cast("decimal(30,8)")
    return F.round(F.try_divide(total, F.sum(n).cast("decimal(15,0)")), digits)


def agg_count_distinct(col: str | Column) -> Column:
    return F.count_distinct(col)


def agg_conditional(condition: Column) -> Column:
    return F.count_if(condition)


def agg_avg_round(col: str | Column, digits: int) -> Column:
    return F.round(F.avg(col), digits)


def agg_stddev(col: str | Column) -> Column:
    """Sample standard deviation; NULL for a single row."""
    return F.stddev_samp(col)


def agg_ratio(n: Column, d: Column) -> Column:
    return F.try_divide(n, d)


def string_list(col: str, sep: str = ", ") -> Column:
    """Distinct values in ascending order, joined; NULL if there is none.

    Sets are merged map-side, so a group sends its distinct values once per task.
    """
    values = F.array_sort(F.collect_set(F.col(col).cast("string")))
    return F.when(F.count(col) > 0, F.array_join(values, sep))


def with_distinct_list(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    name: str,
    count_name: str | None = None,
    sep: str = ", ",
) -> DataFrame:
    """Per group: the distinct values of a column, sorted and joined, and their number.

    Rows are made distinct by a plain hash aggregate first; only its result,
    one row per value and group, enters the list.
    """
    distinct = df.select(*keys, col).distinct()
    aggs = [string_list(col, sep).alias(name)]
    if count_name:
        aggs.append(F.count(col).alias(count_name))
    return distinct.groupBy(*keys).agg(*aggs)


def with_repeated_list(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    name: str,
    count_name: str | None = None,
    rows_name: str | None = None,
    sums: Sequence[str] = (),
    sep: str = ", ",
) -> DataFrame:
    """Per group: all values of a column sorted and joined, repeats included.

    ``count_name`` adds how many values there are, ``rows_name`` how many rows, and
    ``sums`` the totals of further columns. Equal values are combined first
    (map-side), so that a group is built from one row per distinct value and not
    from every row that it holds.
    """
    combined = df.groupBy(*keys, col).agg(
        agg_rows(df).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    piece = F.expr(f"array_join(array_repeat(CAST({col} AS STRING), CAST(_rows AS INT)), '{sep}')")
    combined = combined.withColumn("_piece", F.when(F.col(col).isNotNull(), piece))
    aggs = [F.expr(f"listagg(_piece, '{sep}') WITHIN GROUP (ORDER BY {col})").alias(name)]
    if count_name:
        present = F.when(F.col(col).isNotNull(), F.col("_rows")).otherwise(0)
        aggs.append(F.sum(present).alias(count_name))
    if rows_name:
        aggs.append(F.sum("_rows").alias(rows_name))
    aggs += [F.sum(f"_sum_{c}").alias(c) for c in sums]
    return combined.groupBy(*keys).agg(*aggs)


def list_parts(
    df: DataFrame, keys: Sequence[str], col: str, name: str, part_chars: int = 1_000_000, sep: str = ", "
) -> DataFrame:
    """(keys, part, name): all values of a column sorted and joined, repeats included, in numbered parts of bounded length.

    A part holds the values that begin within its ``part_chars`` characters of the group's whole list, so joining the parts in order with
    ``sep`` gives the list; a part is longer than the bound by one value at most. Values are counted first, and their places follow from a
    running sum of lengths, so a value that is repeated without end is cut by arithmetic. Nulls are left out.
    """
    counted = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).cast("string").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    width = (F.length("_v") + len(sep)).cast("bigint")
    before = F.sum(F.col("_n") * width).over(Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.withColumn("_width", width).withColumn("_at", F.coalesce(before, F.lit(0)))
    # the parts in which a repetition of the value begins, and how many of them do
    numbers = F.expr(f"sequence(_at div {part_chars}, (_at + (_n - 1) * _width) div {part_chars})")
    spread = placed.withColumn("part", F.explode(numbers))

    def begun(part: Column) -> Column:
        """Repetitions that begin before a part."""
        ahead = F.greatest(part * part_chars - F.col("_at"), F.lit(0))
        return F.least(F.col("_n"), F.floor((ahead + F.col("_width") - 1) / F.col("_width")))

    spread = spread.withColumn("_times", (begun(F.col("part") + 1) - begun(F.col("part"))).cast("int"))
    spread = spread.where("_times > 0").withColumn("_piece", F.expr(f"array_join(array_repeat(_v, _times), '{sep}')"))
    return spread.groupBy(*keys, "part").agg(F.expr(f"listagg(_piece, '{sep}') WITHIN GROUP (ORDER BY _v)").alias(name))
