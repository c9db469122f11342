"""Null against absent in payloads, bad records, dates in two shapes."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from brisa import schemas
from brisa.operators import flatten
from brisa.sources import files

GOOD = (
    '"value":7.5,"parameter":{"id":2,"name":"pm25","units":"µg/m³"},'
    '"period":{"label":"raw","interval":"01:00:00",'
    '"datetimeFrom":{"utc":"2021-08-13T04:00:00Z","local":"2021-08-13T00:00:00-04:00"},'
    '"datetimeTo":{"utc":"2021-08-13T05:00:00Z","local":"2021-08-13T01:00:00-04:00"}}'
)


def records(spark, *texts, sensor=1045):
    rows = [(sensor, 25, "Parque", t) for t in texts]
    df = spark.createDataFrame(rows, "sensor_id INT, location_id INT, location_name STRING, json STRING")
    return df.withColumnRenamed("json", "record")


def reasons(spark, *texts, **kwargs):
    marked = flatten.with_reject_reason(records(spark, *texts, **kwargs))
    return [r.reason for r in marked.select("reason").collect()]


def test_measurement_columns(spark):
    row = flatten.flatten_measurements(records(spark, "{" + GOOD + "}")).first()
    assert (row.sensor_id, row.location_id, row.parameter_name) == (1045, 25, "pm25")
    assert row.value == Decimal("7.500000")
    assert row.period_from_utc == datetime(2021, 8, 13, 4)
    assert row.period_from_local == datetime(2021, 8, 13, 0)  # the wall clock, offset dropped
    assert row.period_to_local == datetime(2021, 8, 13, 1)
    assert row.has_flags is False and row.coverage_expected_count is None
    assert str(row.period_date) == "2021-08-13"
    assert '"sensor_id":1045' in row.raw_data and '"location_name":"Parque"' in row.raw_data


def test_measurement_columns_are_those_of_the_table(spark):
    columns = flatten.flatten_measurements(records(spark, "{" + GOOD + "}")).columns
    assert set(columns) | {"extracted_at"} == set(schemas.MEASUREMENTS.names)


def test_absent_parts_are_fine_and_null_parts_are_not(spark):
    assert reasons(spark, "{" + GOOD + "}", '{"value":1}', "{}") == [None, None, None]
    for part in ("coverage", "flagInfo", "parameter", "period"):
        assert reasons(spark, f'{{"{part}":null}}') == [f"{part} is not an object"]
        assert reasons(spark, f'{{"{part}":"text"}}') == [f"{part} is not an object"]
    assert reasons(spark, '{"period":{"datetimeFrom":null}}') == ["period.datetimeFrom is not an object"]
    assert reasons(spark, '{"period":{"datetimeTo":{}}}') == [None]


def test_no_position_is_fine_in_any_form(spark):
    texts = ['{"coordinates":%s}' % c for c in ("null", "{}", "false", "0", '""', "[]")]
    assert reasons(spark, *texts) == [None] * 6
    assert reasons(spark, '{"coordinates":"here"}') == ["coordinates is not an object"]


def test_values_that_do_not_fit(spark):
    assert reasons(spark, '{"value":"n/a"}', '{"value":1e12}', '{"value":"6.5"}', '{"value":null}') == [
        "value does not fit decimal(15,6)", "value does not fit decimal(15,6)", None, None,
    ]
    assert reasons(spark, '{"coordinates":{"latitude":123.45,"longitude":1}}') == [
        "coordinates.latitude does not fit decimal(10,8)"
    ]
    assert reasons(spark, '{"period":{"datetimeFrom":{"utc":"yesterday"}}}') == [
        "period.datetimeFrom.utc does not fit timestamp_ntz"
    ]
    assert reasons(spark, '{"flagInfo":{"hasFlags":"maybe"}}') == ["flagInfo.hasFlags does not fit boolean"]


def test_counts_may_be_written_as_numbers_or_text(spark):
    raw = records(spark, '{"coverage":{"expectedCount":"7","observedCount":6.0}}')
    row = flatten.flatten_measurements(flatten.split_good_bad(raw)[0]).first()
    assert (row.coverage_expected_count, row.coverage_observed_count) == (7, 6)


def test_records_that_are_no_objects(spark):
    assert reasons(spark, "[1]", '"text"', "7", "{broken") == ["record is not an object"] * 4


def test_variant_records_are_taken_too(spark):
    raw = records(spark, "{" + GOOD + "}").withColumn("record", F.parse_json("record"))
    assert flatten.flatten_measurements(raw).first().value == Decimal("7.5")


def test_missing_sensor(spark):
    assert reasons(spark, "{}", sensor=None) == ["sensor_id is missing"]


def test_split_keeps_every_record_once(spark):
    raw = records(spark, "{" + GOOD + "}", '{"coverage":null}', '{"value":"x"}', "{}")
    good, bad = flatten.split_good_bad(raw)
    assert (good.count(), bad.count()) == (2, 2)


def test_flags(spark):
    raw = records(
        spark, '{"flagInfo":{"hasFlags":true}}', '{"flagInfo":{"hasFlags":null}}', '{"flagInfo":{}}', "{}"
    )
    assert [r.has_flags for r in flatten.flatten_measurements(raw).collect()] == [True, None, False, False]


def location(spark, text):
    return flatten.flatten_locations(
        spark.createDataFrame([(text,)], "json STRING").select(F.parse_json("json").alias("record"))
    ).first()


def test_location_dates_flags_and_lists(spark):
    row = location(
        spark,
        '{"id":25,"datetimeFirst":{"utc":"2021-08-13T04:00:00Z","local":"2021-08-13T00:00:00-04:00"},'
        '"datetimeLast":"2021-08-20T00:00:00Z","isMonitor":null,"sensors":[{"id":7}]}',
    )
    assert row.datetime_first == datetime(2021, 8, 13, 4)
    assert row.datetime_last == datetime(2021, 8, 20)
    assert row.is_mobile is False and row.is_monitor is None
    assert (row.sensors, row.instruments) == ('[{"id":7}]', "[]")


def test_location_with_null_part_is_set_aside(spark):
    raw = spark.createDataFrame(
        [('{"id":1,"owner":null}',), ('{"id":2}',)], "json STRING"
    ).select(F.parse_json("json").alias("record"))
    good, bad = flatten.split_good_bad(raw, flatten.location_reject_reason)
    assert good.count() == 1
    assert bad.first().reason == "owner is not an object"


def test_country_parameters(spark):
    texts = ['{"id":1}', '{"id":2,"parameters":null}', '{"id":3,"parameters":[{"id":2,"name":"pm25"}]}']
    raw = spark.createDataFrame([(t,) for t in texts], "json STRING").select(
        F.parse_json("json").alias("record")
    )
    rows = flatten.flatten_countries(raw).orderBy("country_id").collect()
    assert [r.parameters for r in rows] == ["[]", "null", '[{"id":2,"name":"pm25"}]']


def test_explode_sensors(spark):
    rows = [
        (1, "a", '[{"id":7},{"parameter":{"name":"o3"}},{},{"id":0}]'),
        (2, "b", "[]"),
        (3, "c", None),
        (4, "d", '[{"id":8,"parameter":{"name":"pm25","units":"µg/m³"}}]'),
    ]
    df = spark.createDataFrame(rows, "location_id INT, name STRING, sensors STRING")
    assert [tuple(r) for r in flatten.explode_sensors(df).orderBy("sensor_id").collect()] == [
        (7, 1, "a", "N/A", "N/A"), (8, 4, "d", "pm25", "µg/m³"),
    ]


def test_post_without_a_key_fails(spark):
    df = spark.createDataFrame([(1, 2, None, "x")], schemas.POST)
    with pytest.raises(PySparkException, match="post without title"):
        flatten.flatten_posts(df).collect()


def test_envelopes_from_pretty_printed_files(spark, tmp_path):
    for page, ids in ((1, [1, 2]), (2, [3])):
        results = ",\n".join(f'{{"id": {i}}}' for i in ids)
        (tmp_path / f"p{page}.json").write_text(
            f'{{\n "meta": {{"found": ">2", "page": {page}, "limit": 2}},\n "results": [{results}]\n}}'
        )
    rows = files.read_envelopes(spark, str(tmp_path))
    ids = rows.select("page", "found", F.try_variant_get("record", "$.id", "int").alias("id"), "seq.pos")
    assert sorted(tuple(r) for r in ids.collect()) == [(1, ">2", 1, 0), (1, ">2", 2, 1), (2, ">2", 3, 0)]


def test_json_list_in_one_file(spark, tmp_path):
    (tmp_path / "posts.json").write_text('[\n {"id": 1, "userId": 2, "title": "t", "body": "b"},\n {"id": 2}\n]')
    df = files.read_json_list(spark, str(tmp_path), schemas.POST)
    assert [(r.id, r.userId) for r in df.orderBy("id").collect()] == [(1, 2), (2, None)]


def test_csv_with_blanks_after_commas(spark, tmp_path):
    (tmp_path / "d.csv").write_text("product_id, delivery_dt\n10005, 2022-01-01\n10001, 2021-12-30\n")
    rows = files.read_csv(spark, str(tmp_path), schemas.DELIVERIES).collect()
    assert sorted((r.product_id, str(r.delivery_dt)) for r in rows) == [
        (10001, "2021-12-30"), (10005, "2022-01-01"),
    ]


def test_only_records_that_lack_a_part_are_parsed_twice(spark):
    """One parse per record comes before the rules; each other stands behind a test for a missing part."""
    whole = "{" + GOOD + ',"coverage":{},"coordinates":{},"flagInfo":{"hasFlags":true}}'
    texts = [whole, whole[:-1], whole[:-1] + ',"coverage":null}', whole.replace('{"hasFlags":true}', "7"), "{}", "[1]", "", whole + " x"]
    parsed = flatten.parse_measurements(records(spark, *texts))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    no_object = "record is not an object"
    expected = [None, no_object, "coverage is not an object", "flagInfo is not an object", None, no_object, no_object, None]
    assert reasons(spark, *texts) == expected
    for given in (parsed, records(spark, *texts)):
        flags = [r.has_flags for r in flatten.flatten_measurements(given).collect()]
        assert flags == [True, False, True, False, False, False, False, True]
