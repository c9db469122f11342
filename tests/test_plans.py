"""The physical plans that the design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from brisa.bindings import Model
from brisa.operators.ordering import latest_per_key

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    queries = contract.queries()
    return lambda key: plan(queries[key](spark, FOLDER))


def test_filters_and_columns_reach_the_scan(plans):
    text = plans("m_pm25_daily")
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in text
    assert "EqualTo(event_type,click)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


def test_statistics_are_broadcast_and_the_facts_not_shuffled(plans):
    text = plans("m_spikes")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "hashpartitioning" not in text


@pytest.mark.parametrize("key", ["ls_report", "s_integrity", "lc_coverage", "union_metrics"])
def test_metric_rows_read_the_facts_once(plans, key):
    text = plans(key)
    fact = "lineitem" if key in ("ls_report", "s_integrity") else "events" if key == "union_metrics" else "orders"
    assert text.count(f"{fact}.parquet") == 1


def test_top_k_does_not_sort_all(plans):
    for key in ("m_no2_top", "ls_top10", "s_variety", "topk"):
        assert "TakeOrderedAndProject" in plans(key)


def test_keys_are_limited_before_the_shuffle(spark):
    m = Model(spark, FOLDER).measurements()
    text = plan(latest_per_key(m, ["sensor_id"], ["arrived_at", "id"]))
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:shuffle] and "WindowGroupLimit" in text[shuffle:]


def test_dimensions_that_are_not_asked_for_are_not_read(spark):
    t = Model(spark, FOLDER)
    assert "part.parquet" not in plan(t.station("id", "name", "locality"))
    assert "supplier.parquet" not in plan(t.station("id", "sensor_name"))


def test_no_cartesian_products(plans):
    for key in contract.queries():
        if key.startswith(("m_", "s_", "c_", "ls_", "lc_")):
            assert "CartesianProduct" not in plans(key), key


def test_day_bound_prunes_the_partitions(spark):
    from brisa.operators.filters import filter_recent
    from brisa.session import scratch_path

    path = scratch_path(spark, "days")
    m = Model(spark, FOLDER).measurements().withColumn("period_date", F.to_date("period_from_utc"))
    m.write.partitionBy("period_date").parquet(path)
    text = plan(filter_recent(spark.read.parquet(path), "period_from_utc", "2024-01-31", 3))
    assert "PartitionFilters: [isnotnull(period_date" in text


@pytest.mark.parametrize("key", ["s_overview", "s_by_timezone", "ls_by_locality", "ls_report", "ls_country_counts"])
def test_station_rows_are_combined_before_dimensions_are_joined(plans, key):
    """On the way from the scan of the facts up to the first join there is an aggregate."""
    above = plans(key).split("lineitem.parquet")[0].splitlines()
    nearest = next(line for line in reversed(above) if "Aggregate" in line or "Join" in line)
    assert "HashAggregate" in nearest, key
