"""The model tables as tables of Spark's session catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import schemas
from brisa.operators.loads import align_schema


def _fields(name: str) -> tuple[list[T.StructField], list[str]]:
    """Columns in the order of the stored table, and the partition column, which comes last."""
    table = schemas.TABLES[name]
    parts = list(table.partition_by[:1])
    return sorted(table.schema.fields, key=lambda f: f.name in parts), parts


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """Create the database and those of its model tables that are absent; name the new ones. ``location`` is a shared folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    created = []
    for name in schemas.TABLES:
        if spark.catalog.tableExists(f"{database}.{name}"):
            continue
        fields, parts = _fields(name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        partitioned = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet{partitioned}")
        created.append(name)
    return created


def load_table(spark: SparkSession, database: str, name: str, df: DataFrame) -> None:
    """Replace a table, or of a partitioned one the partitions that the rows belong to; absent columns get their default or NULL."""
    table = schemas.TABLES[name]
    fields, parts = _fields(name)
    rows = align_schema(df, table.schema, table.defaults).select([f.name for f in fields])
    if parts:
        rows = rows.hint("rebalance", *parts)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # insertInto reads the setting, not a writer's option
    try:
        rows.write.insertInto(f"{database}.{name}", overwrite=True)
    finally:
        spark.conf.set(mode, before)


def catalog_inventory(spark: SparkSession, database: str, n: int = 2) -> DataFrame:
    """(table_name, rows, samples): every table of a database with its number of rows and any ``n`` of them as JSON texts."""
    found = []
    for listed in spark.catalog.listTables(database):
        table = spark.table(f"{database}.{listed.name}")
        few = table.limit(n).agg(F.collect_list(F.to_json(F.struct("*")))).scalar()
        found.append(
            table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(listed.name).alias("table_name"), "rows", few.alias("samples"))
        )
    return reduce(DataFrame.unionAll, found)
