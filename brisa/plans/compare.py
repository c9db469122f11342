"""Two tables compared by content, and ranges of days answered from one cumulative count."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def _checksum() -> list:
    """Of rows in any order: their number, and the sum and the exclusive or of their hashes."""
    return [
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_hash").cast("decimal(20,0)")).alias("s"), F.bit_xor("_hash").alias("x"),
    ]


def _hashed(df: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """Key, bucket of the key and hash of the row. A null is told apart from each value by its own mark."""
    marked = [F.struct(F.col(c).isNull(), F.col(c)) for c in columns]
    return df.select(
        *key, F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("_bucket"), F.xxhash64(*marked).alias("_hash")
    )


def table_difference(source: DataFrame, copy: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(key, difference): what a copy lacks ("missing"), has beyond its source ("extra") or holds otherwise ("changed").

    Each side is first reduced to one checksum per bucket of keys; only buckets that differ are looked into, so an equal copy costs one
    aggregate per side. Columns are compared by name, NULL equals NULL; rows that repeat a key are compared together, and
    a key whose rows are fewer or more is changed. There are as many bucket numbers on the driver as buckets.
    """
    columns = sorted(source.columns)
    if columns != sorted(copy.columns):
        raise ValueError("the tables have different columns")
    sides = [_hashed(df, key, columns, buckets) for df in (source, copy)]
    ours, theirs = (s.groupBy("_bucket").agg(F.struct(*_checksum()).alias(f"c{i}")) for i, s in enumerate(sides))
    unequal = ours.join(theirs, "_bucket", "full").where(~F.col("c0").eqNullSafe(F.col("c1")))
    numbers = [r[0] for r in unequal.select("_bucket").collect()]
    per_key = [
        s.where(F.col("_bucket").isin(numbers)).groupBy(*key).agg(F.struct(*_checksum()).alias(f"c{i}"))
        for i, s in enumerate(sides)
    ]
    renamed = per_key[1].select("c1", *[F.col(c).alias(f"_copy_{c}") for c in key])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_copy_{c}")) for c in key])
    both = per_key[0].join(renamed, same, "full").where(~F.col("c0").eqNullSafe(F.col("c1")))
    difference = F.when(F.col("c1").isNull(), "missing").when(F.col("c0").isNull(), "extra").otherwise("changed")
    # a key of the copy alone has its parts there
    return both.select(
        *[F.when(F.col("c0").isNull(), F.col(f"_copy_{c}")).otherwise(F.col(c)).alias(c) for c in key],
        difference.alias("difference"),
    )


def availability_of_ranges(m: DataFrame, ranges: DataFrame, ts: str = "period_from_utc") -> DataFrame:
    """Measurements in each of the ranges, and which is the first with any.

    ``ranges`` is a table (ordinal, range, first_day, last_day) of any size. The measurements are counted once per day and the counts
    added up along the calendar, which has a few ten thousand days at most; a range is the difference of two of these sums.
    """
    daily = m.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ends = daily.agg(F.min("day").alias("low"), F.max("day").alias("high"))
    days = ends.select(F.explode(F.expr("sequence(date_sub(low, 1), high)")).alias("day"))
    upto = F.coalesce(F.sum("n").over(Window.orderBy("day")), F.lit(0))
    sums = days.join(daily, "day", "left").select("day", upto.alias("upto"))
    low, high = (ends.select(c).scalar() for c in ("low", "high"))
    asked = ranges.withColumn("_from", F.date_sub(F.greatest("first_day", low), 1))
    asked = asked.withColumn("_to", F.least("last_day", high))
    before = sums.select(F.col("day").alias("_from"), F.col("upto").alias("_before"))
    until = sums.select(F.col("day").alias("_to"), F.col("upto").alias("_until"))
    found = asked.join(before, "_from", "left").join(until, "_to", "left")
    n = F.coalesce(F.greatest(F.col("_until") - F.col("_before"), F.lit(0)), F.lit(0))
    counted = found.select("ordinal", "range", "first_day", "last_day", n.alias("n"))
    answer = counted.where("n > 0").agg(F.min("ordinal").alias("o")).scalar()
    return counted.withColumn("is_answer", F.coalesce(F.col("ordinal") == answer, F.lit(False)))
