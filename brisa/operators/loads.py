"""Keyed loads.

Running one again with the same batch changes nothing, but for rows with NULL in
the key: these equal no stored row, so an upsert inserts them each time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.operators.ordering import latest_per_key, with_null_key_id
from brisa.session import as_written_table
from brisa.sources import tables


class DuplicateKey(ValueError):
    """A key came twice where the table has no rule for it."""


def stamp(df: DataFrame, as_of: date | datetime | str) -> DataFrame:
    """Set the load time. The clock is the caller's, so that a re-run gives the same rows."""
    return df.withColumn("extracted_at", F.lit(str(as_of)).cast("timestamp_ntz"))


def align_schema(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Bring rows of an older width to the schema: absent columns get their default or NULL."""
    defaults = defaults or {}
    present = {c.lower() for c in df.columns}
    return df.select(*[
        (F.col(f.name) if f.name.lower() in present else F.lit(defaults.get(f.name)))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ])


def reduce_first_last(
    df: DataFrame,
    key: Sequence[str],
    first_cols: Sequence[str],
    last_cols: Sequence[str],
    seq: Sequence[str],
) -> DataFrame:
    """One row per key: some columns of its first record, the others of its last.

    Both picks are map-side combined, so a hot key crosses the shuffle once per task.
    """
    order = F.struct(*seq)
    reduced = (
        with_null_key_id(df, key)
        .groupBy(*key, "_null_key")
        .agg(
            F.min_by(F.struct(*first_cols), order).alias("_first"),
            F.max_by(F.struct(*last_cols), order).alias("_last"),
        )
    )
    return reduced.select(
        *key,
        *[F.col(f"_first.{c}").alias(c) for c in first_cols],
        *[F.col(f"_last.{c}").alias(c) for c in last_cols],
    )


def fail_on_duplicates(df: DataFrame, key: Sequence[str]) -> None:
    known = df.where(~_some_null(key))
    twice = known.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
    if not twice.isEmpty():
        raise DuplicateKey(f"repeated key in {list(key)}")


def _some_null(key: Sequence[str]):
    test = F.lit(False)
    for c in key:
        test = test | F.col(c).isNull()
    return test


def full_refresh(
    target: str,
    df: DataFrame,
    key: Sequence[str],
    seq: Sequence[str],
    on_duplicate: str = "last",
) -> DataFrame:
    """Replace the whole table; the last record per key wins.

    ``on_duplicate="fail"`` is for tables that have no conflict rule. An empty
    batch leaves the table as it is.
    """
    spark = df.sparkSession
    schema = df.drop(*seq).schema
    if not df.isEmpty():
        if on_duplicate == "fail":
            fail_on_duplicates(df, key)
            tables.publish(df.drop(*seq), target)
        else:
            tables.publish(latest_per_key(df, key, seq).drop(*seq), target)
    return tables.read_current(spark, target, schema)


def _generations(old: DataFrame, new: DataFrame, seq: Sequence[str]) -> DataFrame:
    """Stored rows count as arrived before all rows of the batch."""
    stored = old.withColumn("_gen", F.lit(0))
    for c in seq:
        stored = stored.withColumn(c, F.lit(None).cast(new.schema[c].dataType))
    return stored.unionByName(new.withColumn("_gen", F.lit(1)))


def upsert(target: str, df: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Insert, or update every column from the new row; a new version of the table."""
    spark = df.sparkSession
    schema = df.drop(*seq).schema
    both = _generations(tables.read_current(spark, target, schema), df, seq)
    order = ["_gen", *seq]
    tables.publish(latest_per_key(both, key, order).drop(*order), target)
    return tables.read_current(spark, target, schema)


def replace_partition(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the partitions that the rows belong to; all others stay."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def touched(stored: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """Stored rows of the partitions of the batch.

    The values go into the plan, so that no other folder is listed as input: there are no more of them than partitions of the
    table, which the driver knows anyway. A join would read all folders, as the batch has no filter to prune by.
    """
    values = [r[0] for r in batch.select(partition).where(F.col(partition).isNotNull()).distinct().collect()]
    return stored.where(F.col(partition).isin(values))


def _rewrite_days(
    target: str, df: DataFrame, day: str, schema: T.StructType,
    merge: Callable[[DataFrame, DataFrame], DataFrame], written: bool = False,
) -> DataFrame:
    """Merge a batch into the days (or other partitions) that it touches, with one write.

    The batch is written first, as it is read twice. The merged rows go to the staging folder of the dynamic overwrite, which takes the
    place of the touched partitions when all tasks are done; until then the stored ones stay and are read from. Rows without a
    day can meet no stored row and are appended. A first load needs none of this.
    """
    spark: SparkSession = df.sparkSession
    if not tables.exists(spark, target):
        first = merge(spark.createDataFrame([], schema), df)
        first.hint("rebalance", day).write.partitionBy(day).parquet(target)
        return spark.read.schema(schema).parquet(target)
    batch = df if written else as_written_table(df, "batch")
    stored = spark.read.schema(schema).parquet(target)
    merged = merge(touched(stored, batch, day), batch.where(F.col(day).isNotNull()))
    replace_partition(merged.select(schema.names), target, day)
    undated = batch.where(F.col(day).isNull())
    if not undated.isEmpty():
        undated.select(schema.names).write.mode("append").partitionBy(day).parquet(target)
    return spark.read.schema(schema).parquet(target)


def upsert_partial(
    target: str,
    df: DataFrame,
    key: Sequence[str],
    first_cols: Sequence[str],
    last_cols: Sequence[str],
    seq: Sequence[str],
    day: str = "period_date",
    written: bool = False,
) -> DataFrame:
    """Insert, or update only ``last_cols``; ``first_cols`` stay as they first arrived.

    The key must decide the day, so that a key never moves to another partition.
    ``written`` tells that the batch is a table already and cheap to read twice.
    """
    columns = [*key, *first_cols, *last_cols, day]
    schema = T.StructType([df.schema[c] for c in columns])

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = _generations(old.select(columns), new.select(*columns, *seq), seq)
        return reduce_first_last(both, key, [*first_cols, day], last_cols, ["_gen", *seq])

    return _rewrite_days(target, df.select(*columns, *seq), day, schema, merge, written)


def day_replace(target: str, df: DataFrame, key: Sequence[str], day: str) -> DataFrame:
    """Delete the rows with the keys of the batch, insert the batch; other rows of the day stay."""
    schema = df.schema

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        kept = old.join(new.select(*key).distinct(), list(key), "left_anti")
        return kept.select(schema.names).unionByName(new)

    return _rewrite_days(target, df, day, schema, merge)


def upsert_hashed(
    target: str, df: DataFrame, key: Sequence[str], seq: Sequence[str], buckets: int, bucket: str = "key_bucket"
) -> DataFrame:
    """``upsert`` for a large table: only the partitions that hold keys of the batch are read and written.

    Rows lie in partitions by the hash of their key, in the column ``bucket``. ``buckets`` belongs to the table and never changes;
    it is chosen so that a partition is one file of a good size. A row with a null in its key is inserted, as in ``upsert``.
    """
    names = [c for c in df.columns if c not in seq]
    placed = df.withColumn(bucket, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    schema = T.StructType([*[f for f in df.schema.fields if f.name in names], T.StructField(bucket, T.IntegerType())])

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        order = ["_gen", *seq]
        both = _generations(old.select(*names, bucket), new.select(*names, bucket, *seq), seq)
        return latest_per_key(both, key, order).drop(*order)

    return _rewrite_days(target, placed, bucket, schema, merge).drop(bucket)
