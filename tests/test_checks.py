"""Quality checks, paging rules, budget and report corner cases."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from brisa.functions import aggregates, scalars
from brisa.operators import filters, joins, metrics, ordering
from brisa.plans import countries, measurements, paging, quality, stations
from brisa.sources import tables

M = (
    "sensor_id INT, location_id INT, parameter_name STRING, parameter_units STRING, "
    "value DECIMAL(15,6), period_from_utc TIMESTAMP_NTZ"
)


def measured(spark, *rows):
    return spark.createDataFrame(
        [(s, 1, p, "ug/m3", None if v is None else Decimal(str(v)), ts) for s, p, v, ts in rows], M
    )


def pages(spark, found, sizes, limit=100):
    rows = [
        (7, page, str(found), limit) for page, n in enumerate(sizes, start=1) for _ in range(n)
    ]
    return spark.createDataFrame(rows, "source INT, page INT, found STRING, limit INT")


@pytest.mark.parametrize(
    "found, sizes, status",
    [
        (250, [100, 100, 50], "complete"),
        (250, [100, 100], "truncated"),
        (250, [100, 100, 20], "truncated"),
        (">100", [100, 100, 50], "complete"),
        (">100", [100, 100], "truncated"),
        (0, [100, 20], "complete"),
        (">100", [100] * 5, "truncated: page cap"),
        (900, [100] * 5, "truncated: page cap"),
        (500, [100] * 5, "complete"),
        (">100", [100, 100, 100, 100, 10], "complete"),
    ],
)
def test_page_completeness(spark, found, sizes, status):
    row = paging.v_page_completeness(pages(spark, found, sizes), ["source"], 5).first()
    assert (row.landed, row.pages, row.status) == (sum(sizes), len(sizes), status)


def test_repeated_codes_on_later_pages(spark):
    rows = [(1, "CL"), (1, "CL"), (1, None), (2, "CL"), (2, "AR"), (3, None), (3, "AR"), (3, "PE")]
    df = spark.createDataFrame(rows, "page INT, code STRING")
    fresh = joins.anti_new_rows(df, "code", "page")
    assert sorted((r.page, str(r.code)) for r in fresh.collect()) == [
        (1, "CL"), (1, "CL"), (1, "None"), (2, "AR"), (3, "PE"),
    ]
    report = [tuple(r) for r in paging.v_page_overlap(df).collect()]
    assert report == [(1, 3, 3, 0), (2, 2, 1, 1), (3, 3, 1, 2)]


def test_budget_keeps_the_crossing_group_whole(spark):
    sizes = {"a": 900, "b": 1200, "c": 300}
    df = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)], "g STRING")
    kept = {r.g: r["count"] for r in ordering.budget_cutoff(df, "g", 2000).groupBy("g").count().collect()}
    assert kept == {"a": 900, "b": 1200}
    assert ordering.budget_cutoff(df, "g", 900).select("g").distinct().count() == 1
    assert ordering.budget_cutoff(df, "g", 10**6).count() == 2400
    assert ordering.budget_cutoff(df.limit(0), "g", 10).count() == 0


def test_mean_that_rounds_to_the_limit_is_no_exceedance(spark):
    m = measured(
        spark,
        (1, "pm25", "25.004", datetime(2024, 1, 1)),
        (1, "pm25", "25.006", datetime(2024, 1, 2)),
        (1, "pm25", None, datetime(2024, 1, 3)),
    )
    rows = measurements.m_pm25_exceed(m).collect()
    assert [(r.day, r.mean_pm25, r.excess_percent) for r in rows] == [
        (date(2024, 1, 2), Decimal("25.01"), Decimal("0.0"))
    ]


def test_single_measurement_has_no_deviation_and_no_rate(spark):
    m = measured(spark, (1, "no2", 5, datetime(2024, 1, 1)))
    loc = spark.createDataFrame([(1, "here")], "location_id INT, name STRING")
    row = measurements.m_availability(m, loc).first()
    assert (row.n, row.hours, row.per_hour, row.data_quality) == (1, 0, None, None)
    assert measurements.m_no2_top(m, loc, k=1).first().sd_value is None


def test_unknown_location(spark):
    m = measured(spark, (1, "no2", 5, datetime(2024, 1, 1)))
    none = spark.createDataFrame([], "location_id INT, name STRING")
    assert measurements.m_no2_top(m, none).count() == 0
    assert measurements.m_availability(m, none).first().location_name is None


def test_constant_values_have_no_spike(spark):
    m = measured(spark, *[(1, "o3", 5, datetime(2024, 1, d)) for d in range(1, 9)])
    assert measurements.m_spikes(m).count() == 0


def test_spike_statistics_use_all_history(spark):
    rows = [(1, "o3", 5 + (d % 2), datetime(2024, 1, d)) for d in range(1, 21)]
    m = measured(spark, *rows, (1, "o3", 50, datetime(2024, 1, 31)))
    assert [r.measured for r in measurements.m_spikes(m).collect()] == [Decimal("50.00")]


def test_recent_starts_at_midnight(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 7, 23, 59),), (datetime(2024, 1, 8, 0, 0),)], "ts TIMESTAMP_NTZ"
    )
    assert filters.filter_recent(df, "ts", "2024-01-10 15:00:00", 2).count() == 1


def test_like_ignores_case(spark):
    df = spark.createDataFrame([("PM25 µg/m³",), ("no2",), (None,)], "s STRING")
    assert filters.filter_like_ci(df, "s", "%pm2.5%", "%pm25%").count() == 1


def test_json_text_search_and_exact_search(spark):
    df = spark.createDataFrame([('["pm25"]',), ('["pm250"]',), ('[{"id":1,"name":"pm25"}]',)], "p STRING")
    assert filters.filter_json_text(df, "p", ["pm25"]).count() == 3
    assert filters.filter_json_text(df, "p", ["pm25"], exact=True).count() == 2


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x INT")
    assert [r.x for r in ordering.sort_multi(df, "-x").collect()] == [None, 2, 1]
    assert [r.x for r in ordering.sort_multi(df, "x").collect()] == [1, 2, None]
    assert [r.x for r in ordering.sort_multi(df, "-x", nulls_high=False).collect()] == [2, 1, None]


def test_composite_key_with_a_null_part_is_not_counted(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, None), (12, 3)], "id INT, sensor_id INT")
    assert tuple(stations.ls_key_check(df).first()) == (4, 2)


def test_guarded_division(spark):
    df = spark.createDataFrame([(5, 0), (5, 3), (0, 2)], "n BIGINT, d BIGINT")
    got = [r[0] for r in df.select(scalars.guarded_div(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("0.00"), Decimal("1.67"), Decimal("0.00")]


def test_percent_of_an_empty_table(spark):
    m = measured(spark).withColumn("has_flags", F.lit(True)).limit(0)
    row = quality.v_quality(m).first()
    assert (row.total, row.null_values_percent) == (0, 0)


def test_whole_days_are_cut_off(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 3, 23), datetime(2024, 1, 1))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ"
    )
    row = df.select(
        scalars.whole_days(F.col("a"), F.col("b")), scalars.julian_days(F.col("a"), F.col("b")),
        scalars.epoch_hours(F.col("a"), F.col("b")),
    ).first()
    assert tuple(row) == (2, 3, 71)


def country(spark, *rows):
    return spark.createDataFrame(list(rows), "country_id INT, code STRING, name STRING, locations INT, sources INT")


def test_duplicate_codes_and_null_group(spark):
    c = country(spark, (1, None, "a", 1, 1), (2, None, None, 1, 1), (3, "CL", "c", 1, 1), (3, "CL", "c", 1, 1))
    assert {r.code: r.duplicates for r in countries.lc_dup_codes(c).collect()} == {None: 2, "CL": 2}
    found = {r.problem: r.found for r in countries.c_integrity(c).collect()}
    assert found == {
        countries.DUPLICATED_CODES: 1, countries.DUPLICATED_IDS: 1,
        countries.WITHOUT_CODE: 2, countries.WITHOUT_NAME: 1,
    }


def test_checks_of_an_empty_table_count_zero(spark):
    rows = countries.c_integrity(country(spark).limit(0)).collect()
    assert [r.found for r in rows] == [0, 0, 0, 0]


def test_orphans(spark):
    st = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id INT, country_id INT")
    c = country(spark, (7, "CL", "c", 1, 1))
    assert [r.id for r in joins.fk_orphans(st, c).collect()] == [2]


def test_default_codes_of_an_empty_table(spark):
    empty = country(spark).limit(0)
    assert [r.code for r in quality.v_iso_codes(empty).collect()] == sorted(quality.DEFAULT_CODES)
    some = country(spark, (1, "CL", "c", 1, 1), (2, None, "n", 1, 1))
    assert [r.code for r in quality.v_iso_codes(some).collect()] == ["CL"]


def test_short_list_if_the_table_cannot_be_read(spark):
    codes = quality.iso_codes_to_ask(spark, lambda: spark.read.parquet("/nowhere/countries"))
    assert [r.code for r in codes.collect()] == list(quality.FALLBACK_CODES)


def test_totals_of_chosen_sensors(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "sensor_id INT")
    counts = quality.v_total_by_sensor(df, "sensor_id", [1, 2, 9])
    assert [tuple(r) for r in counts.collect()] == [(1, 2), (2, 1)]
    assert quality.grand_total(counts).first().total == 3
    assert quality.grand_total(counts.limit(0)).first().total == 0


def test_validation_fails_on_an_empty_table(spark):
    c = country(spark, (1, "CL", "c", 1, 1))
    loc = spark.createDataFrame([("CL",)], "country_code STRING")
    par = spark.createDataFrame([], "name STRING")
    with pytest.raises(PySparkException, match="table is empty: parameters"):
        quality.v_validate(c, loc, par).collect()


def test_expected_counts(spark):
    def verdict(n):
        return quality.expected_countries(spark.range(n)).first().verdict

    assert [verdict(n) for n in (140, 141, 101, 100)] == ["pass", "better", "better", "fail"]


def test_lists_keep_repeats_and_skip_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k INT, s STRING")
    rows = aggregates.with_repeated_list(df, ["k"], "s", "l", "n", "all").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "a, b, b", 3, 4), (2, None, 0, 1)]
    rows = aggregates.with_distinct_list(df, ["k"], "s", "l", "n", ",").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "a,b", 2), (2, None, 0)]


def test_one_pass_metrics_equal_a_union(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 7)
    one = metrics.union_metrics(df, {"n": aggregates.agg_count(), "g": F.count_distinct("g")}).collect()
    assert [tuple(r) for r in one] == [("n", 100), ("g", 7)]


def test_density_of_a_single_station(spark):
    st = spark.createDataFrame([(1, Decimal(-30), Decimal(-70))], "id INT, latitude DECIMAL(10,8), longitude DECIMAL(11,8)")
    row = stations.s_bbox_density(st).first()
    assert (row.stations, row.area, row.density) == (1, 0, None)


def test_first_range_with_data(spark):
    m = measured(spark, (1, "o3", 1, datetime(2024, 1, 5)), (1, "o3", 1, datetime(2023, 12, 1)))
    ranges = quality.ranges_back(date(2024, 1, 20), (7, 30, 90))
    rows = quality.v_availability_by_range(m, ranges).collect()
    assert [(r.n, r.is_answer) for r in rows] == [(0, False), (1, True), (2, False)]
    assert not any(r.is_answer for r in quality.v_availability_by_range(m.limit(0), ranges).collect())


def test_best_snapshot_takes_the_first_on_a_tie(spark):
    rows = [("a", 0, 0), ("b", 1, 5), ("c", 2, 2), ("c", 2, 3)]
    df = spark.createDataFrame(rows, "snapshot STRING, ordinal INT, rows BIGINT")
    assert tuple(tables.best_snapshot(df).first()) == ("b", 5)
    assert tables.best_snapshot(df.where("rows = 0")).count() == 0


def test_samples(spark):
    found = {"a": spark.range(5), "b": spark.range(1), "c": None}
    assert tables.table_samples(found).groupBy("table_name").count().count() == 2
    assert [r.present for r in tables.inventory(spark, found).collect()] == [True, True, False]


def test_summary_report_has_one_row(spark):
    c = spark.createDataFrame(
        [(1, "2016-01-30T01:00:00Z", 1, 1), (2, "2016-01-30T03:00:00Z", 1, 1), (3, None, 1, 1)],
        "country_id INT, datetimeFirst_raw STRING, locations INT, sources INT",
    )
    row = countries.summary_report(c, "2024-01-01T00:00:00", "source", "endpoint").first()
    assert row.total_countries == 3
    assert row.regional_distribution == {"Europa/África": 1, "América/Otros": 1}


def test_combined_rows_give_the_reports_of_all_rows(spark):
    from brisa.functions.aggregates import ROWS, combined_rows, combined_sides
    from brisa.plans import stations

    rows = [(1, 7, "a", Decimal("1.5")), (1, 7, "a", Decimal("1.5")), (1, 8, "a", Decimal("1.5")), (2, 7, None, None),
            (None, 7, "b", Decimal("-3")), (None, 7, "b", Decimal("-3")), (3, None, "b", Decimal("0.000001")), (None, None, None, None)]
    schema = "id BIGINT, sensor_id BIGINT, locality STRING, latitude DECIMAL(10,8)"
    st = spark.createDataFrame(rows, schema)
    st = st.select("*", F.col("latitude").alias("longitude"), F.col("locality").alias("name"), F.col("sensor_id").cast("string").alias("provider_name"),
                   F.col("sensor_id").cast("string").alias("sensor_name"), F.lit(5).alias("provider_id"), F.lit(date(2024, 1, 2)).alias("extracted_at"))
    keys = [c for c in st.columns if c != "extracted_at"]
    combined = combined_rows(st, keys, "extracted_at")
    assert combined.agg(F.sum(ROWS)).first()[0] == 8 and combined.count() == 6
    for report in (stations.s_overview, stations.s_by_locality, stations.s_with_coords, stations.ls_report, stations.ls_by_city,
                   stations.ls_sensor_types, stations.s_sensor_types, stations.s_by_provider):
        whole, short = (sorted(map(str, report(x).collect())) for x in (st, combined))
        assert whole == short, report.__name__
    sides = combined_sides(st.select("id", "sensor_id", "extracted_at"), ["id", "sensor_id"], "extracted_at")
    found = sides.agg(F.sum(ROWS), F.count_distinct("id"), F.count_distinct("sensor_id")).first()
    assert tuple(found) == (8, 3, 2)
    empty = combined_rows(st.limit(0), keys, "extracted_at")
    assert stations.ls_report(empty).agg(F.sum("value")).first()[0] == 0


def test_combined_means_are_rounded_once(spark):
    from brisa.functions.aggregates import ROWS, agg_avg_rows

    df = spark.createDataFrame([(Decimal("0.0000014"), 1), (Decimal("0.0000015"), 1), (None, 9)], f"x DECIMAL(10,8), {ROWS} BIGINT")
    assert df.agg(agg_avg_rows(df, "x", 6)).first()[0] == Decimal("0.000001")


def test_every_listed_source_has_a_state(spark):
    landed = spark.createDataFrame(
        [(1, 1, "2", 2, 2, "good"), (2, 1, "0", 2, 0, "empty"), (3, 1, "x", 2, 0, "empty"), (4, 9, ">9", 2, 2, "good"),
         (5, 1, "7", 2, 2, "good"), (5, 1, "7", 2, 1, "good"), (6, 9, "7", 2, 2, "good"), (None, None, None, None, 0, "unreadable")],
        "sensor_id BIGINT, page INT, found STRING, `limit` INT, n BIGINT, state STRING",
    )
    sources = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 7, 7)], "sensor_id BIGINT")
    found = paging.v_source_completeness(landed, sources, "sensor_id", 9).collect()
    assert {(r.sensor_id, r.landed, r.status) for r in found} == {
        (1, 2, "complete"), (2, 0, "complete"), (3, 0, "no records"), (4, 2, "truncated: page cap"), (5, 2, "truncated"),
        (6, 2, "truncated: page cap"), (7, 0, "no page"),
    }
    assert len(found) == 7


def test_positions_count_through_all_tasks(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    got = ordering.with_position(df.repartition(9), "-x").collect()
    assert sorted((r.position, r.x) for r in got) == [(i + 1, 999 - i) for i in range(1000)]
    assert ordering.with_position(df.limit(0), "x").count() == 0


def test_counted_locations_fill_what_the_payload_lacks(spark):
    c = spark.createDataFrame([("A", 0), ("B", None), ("C", 9), (None, 0)], "code STRING, locations INT")
    where = spark.createDataFrame([("A",), ("A",), ("C",), (None,)], "country_code STRING")
    got = {r.code: r.locations for r in countries.with_location_counts(c, where).collect()}
    assert got == {"A": 2, "B": 0, "C": 9, None: 0}
    assert countries.with_location_counts(c, where).schema["locations"].dataType.simpleString() == "int"
