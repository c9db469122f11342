"""Joins between the fact tables and their dimensions.

No side is broadcast by hint. The planner broadcasts a table whose files are
below ``spark.sql.autoBroadcastJoinThreshold``; above it the join is a sort-merge
join, whose skewed keys adaptive execution splits. A derived small side (statistics)
is written to a table first, so that its size is known to the planner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions.aggregates import agg_rows
from brisa.functions.scalars import json_elements
from brisa.session import as_written_table


def join_inner_country(countries: DataFrame, station: DataFrame) -> DataFrame:
    """One row per station sensor with the code and name of its country."""
    c = countries.select(
        "country_id", F.col("code").alias("country_code"), F.col("name").alias("country_name")
    )
    return station.join(c, "country_id")


def join_inner_location(m: DataFrame, locations: DataFrame) -> DataFrame:
    """Adds ``location_name``; rows of an unknown location are dropped."""
    return m.join(locations.select("location_id", F.col("name").alias("location_name")), "location_id")


def with_location_name(m: DataFrame, locations: DataFrame) -> DataFrame:
    """Adds ``location_name``; NULL for an unknown location."""
    names = locations.select("location_id", F.col("name").alias("location_name"))
    return m.join(names, "location_id", "left")


def join_left_agg(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    group: Sequence[str],
    counted: str,
    rows_name: str,
    distinct_name: str | None = None,
) -> DataFrame:
    """LEFT JOIN, count per group, keep groups with a count above 0.

    The HAVING drops every unmatched left row, so an inner join gives the same.
    The right side is reduced to one row per (key, counted value) before the join:
    a key that holds a third of all rows is combined map-side and crosses the
    shuffle once per value.
    """
    keys = [right_key, counted] if distinct_name else [right_key]
    reduced = right.where(F.col(counted).isNotNull()).groupBy(*dict.fromkeys(keys))
    reduced = reduced.agg(agg_rows(right).alias("_n"))
    right_cols = [F.col(right_key).alias("_key"), F.col("_n")]
    aggs = [F.sum("_n").alias(rows_name)]
    if distinct_name:
        right_cols.append(F.col(counted).alias("_counted"))
        aggs.append(F.count_distinct("_counted").alias(distinct_name))
    return (
        left.select(left_key, *group)
        .join(reduced.select(*right_cols), F.col(left_key) == F.col("_key"))
        .groupBy(*group)
        .agg(*aggs)
    )


def join_stats_theta(m: DataFrame, stats: DataFrame, on: str, condition: Column) -> DataFrame:
    """Equi-join with per-key statistics plus a condition across both sides.

    The statistics (one row per key) are written first; the planner then sees
    their size and normally broadcasts them, so the fact rows are not shuffled.
    """
    return m.join(as_written_table(stats, "stats"), on).where(condition)


def lateral_explode(df: DataFrame, json: str, name: str) -> DataFrame:
    """Table times the elements of its own JSON array; empty arrays vanish."""
    return df.withColumn(name, F.explode(json_elements(F.col(json))))


def scalar_subquery(df: DataFrame, col: str, lookup: DataFrame, value: str) -> DataFrame:
    """Rows whose column equals the single value that the lookup returns; more than one value is an error."""
    return df.where(F.col(col) == lookup.select(value).scalar())


def anti_new_rows(records: DataFrame, code: str, page: str) -> DataFrame:
    """Keep records whose code did not come on an earlier page.

    A code repeated within its first page stays. The first page per code is a
    map-side combined minimum, written so that the join knows its size.
    """
    first = records.groupBy(F.col(code).alias("_code")).agg(F.min(page).alias("_first"))
    first = as_written_table(first, "first-pages")
    same = F.col(code).eqNullSafe(F.col("_code")) & (F.col(page) == F.col("_first"))
    return records.join(first, same, "left_semi")


def fk_orphans(station: DataFrame, countries: DataFrame) -> DataFrame:
    """Station rows whose country is not known; a NULL reference is no orphan."""
    return station.where(F.col("country_id").isNotNull()).join(
        countries.select("country_id"), "country_id", "left_anti"
    )
