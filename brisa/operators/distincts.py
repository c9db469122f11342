"""Distinct counts that are stored and added up: exact ones as bitmaps, approximate ones as sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.session import as_written_table

# 2 ** 12 registers: a standard error of 1.04 / sqrt(4096) = 1.6 %. Three of these are the stated bound.
SKETCH_BITS = 12
SKETCH_BOUND = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def numbered(values: DataFrame, column: str, number: str) -> DataFrame:
    """A written dictionary: a number for each distinct value that is not null, consecutive within a partition."""
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    return as_written_table(distinct.withColumn(number, F.monotonically_increasing_id()), "dictionary")


def distinct_bitmaps(df: DataFrame, ids: Mapping[str, str], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, counted, bucket, bitmap): the ids that occur in each group, by name of the count and range of 32,768 ids.

    ``ids`` maps names to columns of whole numbers from 0, the closer together the better; null is not counted. All counts are taken in
    one pass, and no row is multiplied by their number: rows are first grouped by the buckets of all ids together, and
    only the bitmaps of these groups are told apart.
    """
    buckets = df.select(
        *groups,
        *[F.bitmap_bucket_number(c).alias(f"_bucket_{n}") for n, c in ids.items()],
        *[F.bitmap_bit_position(c).alias(f"_bit_{n}") for n, c in ids.items()],
    )
    together = buckets.groupBy(*groups, *[f"_bucket_{n}" for n in ids]).agg(
        *[F.bitmap_construct_agg(f"_bit_{n}").alias(f"_bits_{n}") for n in ids]
    )
    apart = F.array(*[
        F.struct(F.lit(n).alias("counted"), F.col(f"_bucket_{n}").alias("bucket"), F.col(f"_bits_{n}").alias("bitmap"))
        for n in ids
    ])
    return merged_bitmaps(together.select(*groups, F.inline(apart)).where("bucket IS NOT NULL"), groups)


def merged_bitmaps(bitmaps: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of finer groups, or of several loads, put together."""
    return bitmaps.groupBy(*groups, "counted", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_counts(bitmaps: DataFrame, names: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """The distinct counts as columns; ``bitmaps`` has one row per group, count and bucket."""
    size = F.bitmap_count("bitmap")
    return bitmaps.groupBy(*groups).agg(*[
        F.coalesce(F.sum(F.when(F.col("counted") == n, size)), F.lit(0)).alias(n) for n in names
    ])


def daily_sketches(df: DataFrame, column: str, groups: Sequence[str]) -> DataFrame:
    """(groups, sketch): a sketch of the distinct values of a column for each group, of some kilobytes at most."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(column, F.lit(SKETCH_BITS)).alias("sketch"))


def sketch_counts(sketches: DataFrame, name: str, groups: Sequence[str] = ()) -> DataFrame:
    """Approximate distinct counts of the groups put together, within SKETCH_BOUND of the exact ones nearly always."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
