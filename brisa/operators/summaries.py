"""Summaries of measurements by day that are kept by what changes.

A summary holds, for each day and parameter, the number of rows and of values and the exact sums of values and of their squares. Sums can be
added and taken back, so an upsert needs only the rows that it replaces and those that it brings: the summary of the table after it is
the one before it plus the summary of these rows, the old ones negative. Means and deviations of any span of days follow from it
without the measurements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.operators.loads import touched
from brisa.operators.ordering import latest_per_key

SCHEMA = (
    "day DATE, parameter_name STRING, rows BIGINT, n BIGINT, total DECIMAL(38,6), squares DECIMAL(38,12)"
)
GROUP = ["day", "parameter_name"]


def _summed(rows: DataFrame, sign: Column) -> DataFrame:
    value = F.col("value").cast("decimal(15,6)")
    return rows.groupBy(*GROUP).agg(
        F.sum(sign).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.when(value.isNotNull(), sign)), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum(sign.cast("decimal(1,0)") * value), F.lit(0)).cast("decimal(38,6)").alias("total"),
        F.coalesce(F.sum(sign.cast("decimal(1,0)") * (value * value)), F.lit(0)).cast("decimal(38,12)").alias("squares"),
    )


def _by_day(m: DataFrame, ts: str) -> DataFrame:
    return m.where(F.col(ts).isNotNull()).withColumn("day", F.to_date(ts))


def daily_summary(m: DataFrame, ts: str = "period_from_utc") -> DataFrame:
    """The summary of a whole table. Undated rows belong to no day."""
    return _summed(_by_day(m, ts), F.lit(1))


def summary_changes(
    stored: DataFrame | None, batch: DataFrame, key: Sequence[str], seq: Sequence[str],
    ts: str = "period_from_utc", day: str = "period_date",
) -> DataFrame:
    """What an upsert of ``batch`` into ``stored`` adds to the summary; to be taken before the upsert.

    Of the stored rows only those with a key of the batch are used, and only their days are read. A row with a null in its key
    replaces none. ``batch`` should be a written table, as it is read twice.
    """
    new = latest_per_key(batch, key, seq)
    signed = _by_day(new, ts).select(*GROUP, "value", F.lit(1).alias("sign"))
    if stored is not None:
        old = touched(stored, batch, day).join(batch.select(*key, day).distinct(), [*key, day], "left_semi")
        signed = signed.unionByName(_by_day(old, ts).select(*GROUP, "value", F.lit(-1).alias("sign")))
    return _summed(signed, F.col("sign"))


def merged(parts: DataFrame) -> DataFrame:
    """The sum of summaries and changes; a day and parameter without rows is gone."""
    total = parts.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in ("rows", "n", "total", "squares")])
    return total.where(F.col("rows") > 0)


def _mean(total: Column, n: Column) -> Column:
    """As the mean of a DECIMAL(15,6) column."""
    return F.try_divide(total.cast("decimal(25,6)"), n.cast("decimal(15,0)")).cast("decimal(19,10)")


def summary_means(summary: DataFrame) -> DataFrame:
    """Mean per day and parameter. Without a value the mean is null and ``n`` is 0."""
    return summary.select(*GROUP, F.round(_mean(F.col("total"), F.col("n")), 2).alias("mean_value"), "n")


def _deviation(squares: Column, n: Column) -> Column:
    """Sample deviation from a sum of squared differences; null for a single value."""
    return F.sqrt(F.greatest(squares, F.lit(0.0)) / F.nullif(n - 1, F.lit(0)))


def _own_squares() -> Column:
    """Squared differences from the day's own mean."""
    total = F.col("total").cast("double")
    return F.col("squares").cast("double") - total * total / F.col("n")


def summary_deviations(summary: DataFrame) -> DataFrame:
    """Count, mean and sample deviation per day and parameter, of those with values."""
    valued = summary.where(F.col("n") > 0)
    return valued.select(
        *GROUP, "n", F.round(_mean(F.col("total"), F.col("n")), 2).alias("mean_value"),
        F.round(_deviation(_own_squares(), F.col("n")), 2).alias("sd_value"),
    )


def summary_statistics(summary: DataFrame) -> DataFrame:
    """Mean and sample deviation of each parameter over all days of the summary.

    Days are put together by their counts, means and squared differences: those of all values are the days' own ones plus
    each day's count times the squared difference of its mean from the common one. The rows are as many as days.
    """
    valued = summary.where(F.col("n") > 0)
    of_all = Window.partitionBy("parameter_name")
    common = F.sum("total").over(of_all).cast("double") / F.sum("n").over(of_all)
    between = F.col("n") * F.pow(F.col("total").cast("double") / F.col("n") - common, 2)
    days = valued.withColumn("apart", _own_squares() + between)
    summed = days.groupBy("parameter_name").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("apart").alias("apart")
    )
    return summed.select(
        "parameter_name", _mean(F.col("total"), F.col("n")).alias("mean_all"),
        _deviation(F.col("apart"), F.col("n")).alias("sd_all"),
    )
