"""Model tables as Parquet folders.

A table without a time column is kept as numbered versions; a reader takes the
newest complete one, so a load that dies half-way is never seen. The measurement
table is partitioned by day, and a load replaces only the days that it touches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import schemas
from brisa.operators.ordering import sort_multi


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    fs, folder = _folder(spark, target)
    if not fs.exists(folder):
        return []
    found = []
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("v") and name[1:].isdigit() and exists(spark, f"{target}/{name}/_SUCCESS"):
            found.append(int(name[1:]))
    return sorted(found)


def version_path(target: str, number: int) -> str:
    return f"{target.rstrip('/')}/v{number:08d}"


def publish(df: DataFrame, target: str) -> str:
    """Write the next version of the table. One writer per table at a time."""
    done = versions(df.sparkSession, target)
    path = version_path(target, done[-1] + 1 if done else 1)
    df.write.mode("overwrite").parquet(path)
    return path


def read_current(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Newest version; an empty table if there is none."""
    done = versions(spark, target)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(target, done[-1]))


def read_table(spark: SparkSession, name: str, base: str) -> DataFrame:
    """A model table by name below its base folder, with its fixed schema."""
    table = schemas.TABLES[name]
    target = f"{base.rstrip('/')}/{name}"
    if table.partition_by:
        return spark.read.schema(table.schema).parquet(target)
    return read_current(spark, target, table.schema)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """A database table in parallel slices of a numeric column (needs its driver)."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
    )


def ensure_tables(spark: SparkSession, base: str) -> list[str]:
    """Create the tables that are absent, empty and with their schema; name the new ones."""
    created = []
    for name, table in schemas.TABLES.items():
        target = f"{base.rstrip('/')}/{name}"
        if table.partition_by:
            if exists(spark, target):
                continue
            empty = spark.createDataFrame([], table.schema)
            empty.write.partitionBy(table.partition_by[0]).parquet(target)
        else:
            if versions(spark, target):
                continue
            publish(spark.createDataFrame([], table.schema), target)
        created.append(name)
    return created


def inventory(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], snapshot: str | None = None
) -> DataFrame:
    """Which tables are there and how many rows they have; an absent one counts 0."""
    rows = []
    for ordinal, (name, df) in enumerate(tables.items()):
        present = df is not None
        counted = (df if present else spark.range(0)).agg(F.count(F.lit(1)).alias("rows"))
        columns = [F.lit(name).alias("table_name"), F.lit(present).alias("present"), F.col("rows")]
        if snapshot is not None:
            columns.insert(0, F.lit(snapshot).alias("snapshot"))
        rows.append(counted.select(*columns))
    return reduce(DataFrame.unionAll, rows)


def open_tables(
    spark: SparkSession, base: str, names: Sequence[str], suffix: str = ".parquet"
) -> dict[str, DataFrame | None]:
    """Plain Parquet files below a folder, None for those that are absent."""
    paths = {n: f"{base.rstrip('/')}/{n}{suffix}" for n in names}
    return {n: spark.read.parquet(p) if exists(spark, p) else None for n, p in paths.items()}


def table_samples(tables: Mapping[str, DataFrame | None], n: int = 2) -> DataFrame:
    """Two rows (or n) of each table as JSON text."""
    parts = [
        df.limit(n).select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("sample"))
        for name, df in tables.items()
        if df is not None
    ]
    return reduce(DataFrame.unionAll, parts)


def best_snapshot(found: DataFrame) -> DataFrame:
    """Snapshot with the most rows; on a tie the one listed first. None if all are empty.

    ``found`` has ``snapshot``, ``ordinal`` and ``rows``.
    """
    total = found.groupBy("snapshot", "ordinal").agg(F.sum("rows").alias("total_rows"))
    ranked = sort_multi(total.where(F.col("total_rows") > 0), "-total_rows", "ordinal")
    return ranked.limit(1).select("snapshot", "total_rows")
