"""Readers and writers of files. Every schema is given, none is inferred."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import schemas
from brisa.operators.filters import filter_halfopen


# Where Spark puts the text of a page that does not fit the schema.
RAW_PAGE = "_corrupt_record"


def with_raw_page(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RAW_PAGE, T.StringType())])


def stream_pages(spark: SparkSession, path: str, schema: T.StructType = schemas.SENSOR_ENVELOPE, multi_line: bool = True) -> DataFrame:
    """Landed pages as a stream, with the text of those that cannot be read."""
    return spark.readStream.schema(with_raw_page(schema)).option("multiLine", multi_line).json(path)


def read_envelopes(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.ENVELOPE,
    multi_line: bool = True,
) -> DataFrame:
    """Landed pages ``{meta, results[]}``, one row per result in arrival order.

    Pages that are written one per line should be read with ``multi_line=False``,
    as such files can be split.
    """
    pages = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return explode_envelopes(pages)


def explode_envelopes(pages: DataFrame) -> DataFrame:
    """One row per result. ``seq`` orders by load run, page and position.

    The run is the folder ``run=...`` of the landing; without it the file time counts. Pages that were read with their raw text
    (``stream_pages``) lose nothing: a cut or malformed one is one row with this text and ``unreadable`` true.
    """
    results = F.col("results")
    if RAW_PAGE in pages.columns:
        results = F.when(F.col(RAW_PAGE).isNotNull(), F.array(RAW_PAGE)).otherwise(results)
        pages = pages.withColumn("results", results).withColumn("unreadable", F.col(RAW_PAGE).isNotNull()).drop(RAW_PAGE)
    context = [c for c in pages.columns if c not in ("meta", "results", "run")]
    run = F.col("run") if "run" in pages.columns else F.col("_metadata.file_modification_time")
    return pages.select(
        *context,
        F.col("meta.page").alias("page"),
        F.col("meta.found").alias("found"),
        F.col("meta.limit").alias("limit"),
        run.alias("_run"),
        F.posexplode("results").alias("_pos", "record"),
    ).select(
        *context,
        "page",
        "found",
        "limit",
        "record",
        F.struct(F.col("_run").alias("run"), "page", F.col("_pos").alias("pos")).alias("seq"),
    )


def landed_pages(spark: SparkSession, path: str, schema: T.StructType = schemas.ENVELOPE, multi_line: bool = True) -> DataFrame:
    """One row per landed page, with the file it is in, its number of records and its state.

    A page that is cut or malformed is "unreadable" and known by its file only; one whose list is empty or null
    is "empty"; all others are "good". None is left out.
    """
    pages = spark.read.schema(with_raw_page(schema)).option("multiLine", multi_line).json(path)
    readable = F.col(RAW_PAGE).isNull()
    n = F.coalesce(F.size("results"), F.lit(0))
    n = F.when(readable & (n > 0), n).otherwise(0).cast("bigint")
    told = {c: F.col(c) for c in schema.names if c not in ("meta", "results", "run")}
    told |= {c: F.col(f"meta.{c}") for c in ("page", "found", "limit")}
    state = F.when(~readable, "unreadable").when(n == 0, "empty").otherwise("good")
    return pages.select(
        F.col("_metadata.file_path").alias("file"), *[F.when(readable, c).alias(name) for name, c in told.items()],
        n.alias("n"), state.alias("state"),
    )


def tag_context(records: DataFrame, sensors: DataFrame) -> DataFrame:
    """Adds the owner keys of the sensor whose page a record came on.

    No record is lost: those of a sensor that is not in the list have no owner and no ``listed``. A sensor that is
    listed twice counts once.
    """
    owners = sensors.select("sensor_id", "location_id", "location_name").dropDuplicates(["sensor_id"])
    return records.join(owners.withColumn("listed", F.lit(True)), "sensor_id", "left")


def read_json_list(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """A bare JSON list of objects (or one object per line)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; blanks after the commas belong neither to names nor to values."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .csv(path)
    )


# Spark writes milliseconds by default and drops what is finer.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, **_TIMES).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_TIMES).json(path)


def export_slice(df: DataFrame, ts: str, start: date, end: date, base: str) -> str:
    """Rows of ``[start, end)`` as CSV under the key of the start day, replacing it."""
    path = f"{base.rstrip('/')}/{start:%Y%m%d}"
    write_csv(filter_halfopen(df, ts, start, end), path)
    return path


def export_days(df: DataFrame, ts: str, start: date, end: date, base: str) -> None:
    """All days of ``[start, end)`` in one job, one folder per day; only these are replaced."""
    (
        filter_halfopen(df, ts, start, end)
        .withColumn("dt", F.date_format(ts, "yyyyMMdd"))
        .hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(header=True, **_TIMES)
        .partitionBy("dt")
        .csv(base)
    )


def read_exported_day(spark: SparkSession, base: str, day: date, schema: T.StructType) -> DataFrame:
    return read_csv(spark, f"{base.rstrip('/')}/{day:%Y%m%d}", schema)
