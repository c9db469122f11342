"""Keyed loads: what wins, what stays, and that running again changes nothing."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from brisa import schemas
from brisa.operators import loads
from brisa.operators.ordering import latest_per_key
from brisa.session import scratch_path
from brisa.sources import files, tables

KEY = ["sensor_id", "period_from_utc", "period_to_utc"]
FIRST, LAST, SEQ = ["location_id", "period_label"], ["value"], ["seq"]
DDL = (
    "sensor_id INT, period_from_utc TIMESTAMP_NTZ, period_to_utc TIMESTAMP_NTZ, location_id INT, "
    "period_label STRING, value INT, seq INT"
)


def hour(day, h):
    return datetime(2024, 1, day, h)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), DDL).withColumn("period_date", F.to_date("period_from_utc"))


def content(df):
    return sorted(
        (tuple(r) for r in df.select(*KEY, *FIRST, *LAST).collect()), key=lambda r: tuple(map(str, r))
    )


A1 = (1, hour(1, 0), hour(1, 1), 10, "first", 100, 1)
A2 = (1, hour(1, 0), hour(1, 1), 20, "second", 200, 2)
A3 = (1, hour(1, 0), hour(1, 1), 30, "third", 300, 3)
B1 = (2, hour(2, 5), hour(2, 6), 40, "b", 400, 4)
HOLE = (3, hour(1, 0), None, 50, "hole", 500, 5)
UNDATED = (4, None, None, 60, "undated", 600, 6)


def load(target, df):
    return loads.upsert_partial(target, df, KEY, FIRST, LAST, SEQ)


MERGED = (1, hour(1, 0), hour(1, 1), 10, "first", 300)


def test_first_and_last_columns_in_one_batch(spark):
    result = load(scratch_path(spark, "t"), batch(spark, A2, A3, A1, B1))
    assert content(result) == [MERGED, B1[:6]]


def test_two_batches_equal_one(spark):
    target = scratch_path(spark, "t")
    load(target, batch(spark, A1, B1))
    assert content(load(target, batch(spark, A3, A2))) == [MERGED, B1[:6]]


def test_repeating_a_batch_changes_nothing(spark):
    target = scratch_path(spark, "t")
    once = content(load(target, batch(spark, A1, A2, B1)))
    assert content(load(target, batch(spark, A1, A2, B1))) == once


def test_days_that_are_not_touched_stay(spark):
    target = scratch_path(spark, "t")
    load(target, batch(spark, B1))
    assert content(load(target, batch(spark, A1))) == [A1[:6], B1[:6]]


def test_null_keys_never_conflict(spark):
    target = scratch_path(spark, "t")
    load(target, batch(spark, HOLE, HOLE, UNDATED))
    result = load(target, batch(spark, HOLE, UNDATED))
    assert sorted(r.sensor_id for r in result.collect()) == [3, 3, 3, 4, 4]


def test_touched_days_are_found_by_a_join(spark):
    target = scratch_path(spark, "t")
    load(target, batch(spark, A1, B1))
    assert content(load(target, batch(spark, A2, A3, B1))) == [MERGED, B1[:6]]


def test_hot_key(spark):
    """A third of all rows share one key; the result is that key's first and last."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("sensor_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("period_from_utc"),
        F.lit("2024-01-01 01:00:00").cast("timestamp_ntz").alias("period_to_utc"),
        F.col("id").cast("int").alias("location_id"),
        F.col("id").cast("string").alias("period_label"),
        F.col("id").cast("int").alias("value"),
        F.col("id").cast("int").alias("seq"),
    )
    result = loads.reduce_first_last(rows, KEY, FIRST, LAST, SEQ)
    assert result.count() == 20000
    hot = result.where("sensor_id = 1").first()
    assert (hot.location_id, hot.value) == (0, 29999 - 29999 % 3)


def simple(spark, *rows):
    return spark.createDataFrame(list(rows), "id INT, name STRING, seq INT")


def test_upsert_updates_every_column(spark):
    target = scratch_path(spark, "t")
    loads.upsert(target, simple(spark, (1, "a", 1), (2, "b", 2)), ["id"], ["seq"])
    result = loads.upsert(target, simple(spark, (2, "c", 1), (3, None, 2)), ["id"], ["seq"])
    assert sorted(tuple(r) for r in result.collect()) == [(1, "a"), (2, "c"), (3, None)]


def test_full_refresh_drops_what_is_gone(spark):
    target = scratch_path(spark, "t")
    loads.full_refresh(target, simple(spark, (1, "a", 1), (2, "b", 2)), ["id"], ["seq"])
    new = simple(spark, (2, "x", 1), (2, "y", 2), (None, "n", 3), (None, "n", 4))
    result = loads.full_refresh(target, new, ["id"], ["seq"])
    assert sorted((tuple(r) for r in result.collect()), key=str) == [(2, "y"), (None, "n"), (None, "n")]


def test_empty_batch_leaves_the_table(spark):
    target = scratch_path(spark, "t")
    loads.full_refresh(target, simple(spark, (1, "a", 1)), ["id"], ["seq"])
    assert loads.full_refresh(target, simple(spark).limit(0), ["id"], ["seq"]).count() == 1


def test_duplicate_where_no_rule_exists(spark):
    target = scratch_path(spark, "t")
    with pytest.raises(loads.DuplicateKey):
        loads.full_refresh(target, simple(spark, (1, "a", 1), (1, "b", 2)), ["id"], ["seq"], "fail")
    assert tables.versions(spark, target) == []


def test_a_version_without_its_mark_is_not_read(spark):
    target = scratch_path(spark, "t")
    first = tables.publish(spark.range(3), target)
    second = tables.publish(spark.range(5), target)
    assert (first[-1], second[-1]) == ("1", "2")
    fs, mark = tables._folder(spark, f"{second}/_SUCCESS")
    fs.delete(mark, False)
    assert tables.versions(spark, target) == [1]
    assert tables.read_current(spark, target, spark.range(1).schema).count() == 3


def test_latest_per_key_is_one_row_per_key(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"))
    assert sorted(tuple(r) for r in latest_per_key(df, ["k"], ["seq"]).collect()) == [
        (k, max(i for i in range(1000) if i % 7 == k)) for k in range(7)
    ]


def test_day_replace_keeps_other_rows_of_the_day(spark):
    target = scratch_path(spark, "t")
    rows = spark.createDataFrame(
        [(date(2024, 1, 1), "a"), (date(2024, 1, 1), "b"), (date(2024, 1, 2), "a")], schemas.DAG_RUNS
    )
    loads.day_replace(target, rows, ["dt", "dag_id"], "dt")
    again = rows.where("dag_id = 'a' AND dt = DATE'2024-01-01'")
    assert loads.day_replace(target, again, ["dt", "dag_id"], "dt").count() == 3


def test_align_schema_fills_absent_columns_only(spark):
    df = spark.createDataFrame([(1, "CL", None)], "country_id INT, code STRING, sources INT")
    table = schemas.TABLES["countries"]
    row = loads.align_schema(df, table.schema, table.defaults).first()
    assert (row.country_id, row.locations, row.sources, row.extracted_at) == (1, 0, None, None)


def test_slice_ends(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 1))], "id INT, date DATE"
    )
    base = scratch_path(spark, "orders")
    for _ in range(2):
        path = files.export_slice(df, "date", date(2024, 1, 1), date(2024, 1, 2), base)
    assert path.endswith("/20240101")
    read = files.read_exported_day(spark, base, date(2024, 1, 1), df.schema)
    assert sorted(r.id for r in read.collect()) == [1, 3]


def test_ensure_tables(spark):
    base = scratch_path(spark, "model")
    assert len(tables.ensure_tables(spark, base)) == len(schemas.TABLES)
    assert tables.ensure_tables(spark, base) == []
    for name, table in schemas.TABLES.items():
        df = tables.read_table(spark, name, base)
        assert set(df.columns) == set(table.schema.names) and df.count() == 0
