"""Tables written for point lookups: files clustered by a range of columns, Bloom filters on others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_GROUP_BYTES = 16 * 1024 * 1024
# Share of row groups without a value that its Bloom filter lets through.
FALSE_POSITIVES = 0.01


def write_for_lookups(
    df: DataFrame, path: str, by: Sequence[str], ids: Sequence[str],
    row_group_bytes: int = ROW_GROUP_BYTES, ids_per_group: int = 1_000_000, files: int | None = None,
) -> None:
    """Write a table so that lookups of single values read few of its row groups.

    Files hold ranges of ``by`` and are sorted by it: the minima and maxima of row groups and pages tell where a value of these columns can be.
    Values of ``ids`` lie anywhere, so every row group gets a Bloom filter for each of them, sized for ``ids_per_group`` different values.
    The range partitioning samples the keys; a hot value of the first column is split by the next ones, so end ``by`` with a
    unique column. How many files there are is the cluster's number of shuffle partitions, merged by size, or ``files``.
    """
    dealt = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    writer = dealt.sortWithinPartitions(*by).write.option("parquet.block.size", str(row_group_bytes))
    for c in ids:
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{c}", str(ids_per_group))
            .option(f"parquet.bloom.filter.fpp#{c}", str(FALSE_POSITIVES))
        )
    writer.parquet(path)


def look_up(spark: SparkSession, path: str, schema: T.StructType, column: str, *values: object) -> DataFrame:
    """Rows with one of a few values in a column: an equality that the scan checks against statistics and Bloom filters."""
    rows = spark.read.schema(schema).parquet(path)
    wanted = F.col(column) == F.lit(values[0]) if len(values) == 1 else F.col(column).isin(*values)
    return rows.where(wanted)
