"""Checks on landed pages: did every page of a source arrive, and what is new on each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.functions.aggregates import agg_count
from brisa.operators.ordering import sort_multi

# --- fixed values: highest page that is asked for, per kind of source -------------
PAGE_CAPS = {"countries": 10, "locations": 20, "measurements": 100}
# ----------------------------------------------------------------------------------


def v_page_completeness(records: DataFrame, source: Sequence[str], page_cap: int) -> DataFrame:
    """Per source: records landed against ``found``, the size of the last page, the cap.

    ``found`` counts only if it is a plain number above 0; text such as ``>100`` is
    ignored, and the source is judged by its last page being shorter than the limit.
    Pages are reduced to one row each before the sources are.
    """
    pages = records.groupBy(*source, "page").agg(
        agg_count().alias("n"), F.max("found").alias("found"), F.max("limit").alias("limit")
    )
    number = F.when(F.col("found").rlike("^[0-9]+$"), F.col("found")).try_cast("bigint")
    per_source = pages.groupBy(*source).agg(
        F.sum("n").alias("landed"),
        F.count(F.lit(1)).alias("pages"),
        F.max("page").cast("bigint").alias("last_page"),
        F.max_by("n", "page").alias("last_page_size"),
        F.max("limit").cast("bigint").alias("page_limit"),
        F.max(number).alias("found"),
    )
    all_found = F.coalesce((F.col("found") > 0) & (F.col("landed") >= F.col("found")), F.lit(False))
    short_last = F.col("last_page_size") < F.col("page_limit")
    told_more = F.coalesce(F.col("found") > F.col("landed"), F.lit(False))
    at_cap = F.col("last_page") >= page_cap
    status = (
        F.when(all_found, "complete")
        .when(told_more & at_cap, "truncated: page cap")
        .when(told_more, "truncated")
        .when(short_last, "complete")
        .when(at_cap, "truncated: page cap")
        .otherwise("truncated")
    )
    return sort_multi(per_source.withColumn("status", status), *source)


def v_source_completeness(pages: DataFrame, sources: DataFrame, source: str, page_cap: int) -> DataFrame:
    """Every listed source with its state, also one of which no good page landed.

    ``pages`` has one row per landed page (``files.landed_pages``). A page that landed in several runs counts once, with the most
    records that it had. A source with pages that are all empty has nothing to give if its total is told as 0, and "no records"
    otherwise; of a source without any readable page "no page" is known. Unreadable pages name no source.
    """
    readable = pages.where(F.col("state") != "unreadable").groupBy(source, "page").agg(
        F.max("n").alias("n"), F.max("found").alias("found"), F.max("limit").alias("limit")
    )
    number = F.when(F.col("found").rlike("^[0-9]+$"), F.col("found")).try_cast("bigint")
    per_source = readable.groupBy(source).agg(
        F.sum("n").alias("landed"),
        F.count_if(F.col("n") > 0).alias("good_pages"),
        F.max("page").cast("bigint").alias("last_page"),
        F.max_by("n", "page").alias("last_size"),
        F.max("limit").cast("bigint").alias("limit"),
        F.max(number).alias("found"),
    )
    listed = sources.select(source).distinct().join(per_source, source, "left")
    told_more = F.coalesce(F.col("found") > F.col("landed"), F.lit(False))
    short_last = F.col("last_size") < F.col("limit")
    status = (
        F.when(F.col("landed").isNull(), "no page")
        .when((F.col("landed") == 0) & F.coalesce(F.col("found") == 0, F.lit(False)), "complete")
        .when(F.col("landed") == 0, "no records")
        .when((F.col("found") > 0) & ~told_more, "complete")
        .when((told_more | ~short_last) & (F.col("last_page") >= page_cap), "truncated: page cap")
        .when(told_more | ~short_last, "truncated")
        .otherwise("complete")
    )
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("landed", "good_pages")]
    return sort_multi(listed.select(source, *counts, "last_page", "found", status.alias("status")), source)


def v_page_states(pages: DataFrame, source: Sequence[str]) -> DataFrame:
    """Per source and state: pages and records. Unreadable pages have no source; sources with empty pages only are listed."""
    found = pages.groupBy(*source, "state").agg(agg_count().alias("pages"), F.sum("n").alias("records"))
    return sort_multi(found, *source, "state")


def v_page_overlap(records: DataFrame, code: str = "code", page: str = "page") -> DataFrame:
    """Per page: its records, and how many of them are new or were seen on earlier pages."""
    counted = records.groupBy(code, page).agg(agg_count().alias("_n"))
    # a code's pages are as many as its source has, never its records
    per_code = counted.groupBy(code).agg(
        F.min(page).alias("_first"), F.collect_list(F.struct(F.col(page).alias("_page"), "_n")).alias("_pages")
    )
    pages = per_code.select("_first", F.inline("_pages"))
    new = F.when(F.col("_page") == F.col("_first"), F.col("_n")).otherwise(0)
    report = pages.groupBy(F.col("_page").alias(page)).agg(
        F.sum("_n").alias("records"), F.sum(new).alias("new_records"), F.sum(F.col("_n") - new).alias("repeated_records")
    )
    return sort_multi(report, page)
