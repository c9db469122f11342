"""Reports of (label, number) rows from ONE pass over the table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions.aggregates import agg_rows


def metric_rows(
    df: DataFrame, metrics: Mapping[str, Column], label: str = "metric", value: str = "value"
) -> DataFrame:
    """All metrics in one aggregate, then one row per metric in the given order.

    A UNION ALL of one-row aggregates would scan the table once per branch.
    """
    names = [f"_m{i}" for i in range(len(metrics))]
    one_row = df.agg(*[c.cast("bigint").alias(n) for n, c in zip(names, metrics.values())])
    pairs = F.array(*[
        F.struct(F.lit(text).alias(label), F.col(n).alias(value))
        for n, text in zip(names, metrics)
    ])
    return one_row.select(F.inline(pairs))


def union_metrics(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    return metric_rows(df, metrics)


def union_checks(df: DataFrame, problems: Mapping[str, Column]) -> DataFrame:
    """Rows that break a rule, counted per rule."""
    return metric_rows(
        df, {text: agg_rows(df, test) for text, test in problems.items()}, "problem", "found"
    )


def concat_pages(*pages: DataFrame) -> DataFrame:
    """Append the records of all pages, matching columns by name."""
    result = pages[0]
    for page in pages[1:]:
        result = result.unionByName(page, allowMissingColumns=True)
    return result
