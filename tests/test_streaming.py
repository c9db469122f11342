"""Streams give what the batch gives, over several runs and late corrections."""

from datetime import datetime
from pathlib import Path

import pytest

from brisa import schemas
from brisa.session import scratch_path
from brisa.sources import files
from brisa.streaming import ingest

NOW = "2024-02-01 00:00:00"


def land(folder: Path, run: str, sensor: int, page: int, *records: str) -> None:
    target = folder / f"run={run}"
    target.mkdir(parents=True, exist_ok=True)
    body = ",".join(records)
    (target / f"{sensor}-{page}.json").write_text(
        f'{{"sensor_id":{sensor},"meta":{{"found":"2","page":{page},"limit":1}},"results":[{body}]}}'
    )


def record(value, label="raw", hour=4):
    return (
        f'{{"value":{value},"period":{{"label":"{label}",'
        f'"datetimeFrom":{{"utc":"2021-08-13T{hour:02d}:00:00Z"}},'
        f'"datetimeTo":{{"utc":"2021-08-13T{hour + 1:02d}:00:00Z"}}}}}}'
    )


def test_later_runs_correct_earlier_rows(spark):
    folder = Path(scratch_path(spark, "landing").removeprefix("file:"))
    target, state, rejected = (scratch_path(spark, n) for n in ("target", "state", "rejected"))
    sensors = spark.createDataFrame([(1, 25, "here"), (2, 26, "there")], "sensor_id BIGINT, location_id INT, location_name STRING")

    def run():
        pages = spark.readStream.schema(schemas.SENSOR_ENVELOPE).json(str(folder))
        ingest.incremental_ingest(pages, sensors, target, state, NOW, rejected).awaitTermination()
        rows = spark.read.parquet(target).orderBy("sensor_id", "period_from_utc").collect()
        return [(r.sensor_id, r.period_from_utc, float(r.value), r.period_label, r.location_id) for r in rows]

    four, six = datetime(2021, 8, 13, 4), datetime(2021, 8, 13, 6)
    land(folder, "1", 1, 1, record(1, "first"))
    land(folder, "1", 1, 2, record(2, "second"))
    land(folder, "1", 2, 1, record(9), '{"coverage":null}')
    assert run() == [(1, four, 2.0, "first", 25), (2, four, 9.0, "raw", 26)]

    land(folder, "2", 1, 1, record(3, "third"), record(5, "other", 6))
    expected = [(1, four, 3.0, "first", 25), (1, six, 5.0, "other", 25), (2, four, 9.0, "raw", 26)]
    assert run() == expected
    assert run() == expected  # nothing new has landed

    bad = spark.read.json(rejected)
    assert [r.reason for r in bad.collect()] == ["coverage is not an object"]


def test_every_landed_record_is_loaded_or_kept(spark):
    folder = Path(scratch_path(spark, "landing").removeprefix("file:"))
    target, state, rejected, loaded = (scratch_path(spark, n) for n in ("target", "state", "rejected", "loaded"))
    sensors = spark.createDataFrame([(1, 25, "here")], "sensor_id BIGINT, location_id INT, location_name STRING")
    pages = spark.readStream.schema(schemas.SENSOR_ENVELOPE).json

    def run():
        ingest.incremental_ingest(pages(str(folder)), sensors, target, state, NOW, rejected, loaded).awaitTermination()
        bad = [(r.batch, r.sensor_id, r.reason) for r in spark.read.json(rejected).collect()]
        return sorted(bad), sorted((r.batch, r.records) for r in spark.read.json(loaded).collect())

    land(folder, "1", 1, 1, record(1), record(2), '{"coverage":null}')
    land(folder, "1", 9, 1, record(3))
    first = [(0, 1, "coverage is not an object"), (0, 9, "unknown sensor")]
    assert run() == (first, [(0, 2)])
    land(folder, "2", 9, 1, record(4), record(5, hour=5))
    land(folder, "2", 1, 1, record(6))
    assert run() == ([*first, *[(1, 9, "unknown sensor")] * 2], [(0, 2), (1, 1)])
    assert [float(r.value) for r in spark.read.parquet(target).collect()] == [6.0]

    with pytest.raises(TypeError):  # no folder, no load
        ingest.incremental_ingest(pages(str(folder)), sensors, target, state, NOW)


def test_every_landed_page_is_accounted_for(spark):
    folder = Path(scratch_path(spark, "landing").removeprefix("file:"))
    land(folder, "1", 1, 1, record(1), record(2, hour=5))
    land(folder, "1", 2, 1)
    good = (folder / "run=1" / "1-1.json").read_text()
    (folder / "run=1" / "3-1.json").write_text(good[: len(good) // 2])
    (folder / "run=1" / "4-1.json").write_text('{"sensor_id":4,"meta":{"page":1},"results":null}')
    for multi_line in (True, False):
        found = files.landed_pages(spark, str(folder), schemas.SENSOR_ENVELOPE, multi_line).collect()
        assert sorted((r.file[-8:], r.sensor_id, r.n, r.state) for r in found) == [
            ("1-1.json", 1, 2, "good"), ("2-1.json", 2, 0, "empty"), ("3-1.json", None, 0, "unreadable"), ("4-1.json", 4, 0, "empty"),
        ]


def test_daily_stream_counts_corrections_once_and_late_rows(spark):
    landed, table, target, state = (scratch_path(spark, n) for n in ("landed", "table", "daily", "state"))
    schema = (
        "sensor_id BIGINT, period_from_utc TIMESTAMP_NTZ, period_to_utc TIMESTAMP_NTZ, parameter_name STRING, value DOUBLE, seq INT"
    )

    def run(*rows):
        rows = [(s, at, at and at.replace(hour=at.hour + 1), p, v, 1) for s, at, p, v in rows]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        ingest.daily_avg_stream(stream, table, target, state, ["seq"]).awaitTermination()
        found = spark.read.parquet(target).collect()
        return sorted((r.day.isoformat(), r.parameter_name, r.mean_value, r.n) for r in found)

    first, late, newest = datetime(2024, 1, 1, 4), datetime(2024, 1, 2, 4), datetime(2024, 1, 30, 4)
    assert run((1, first, "no2", 10.0), (1, newest, "no2", 7.0)) == [("2024-01-01", "no2", 10.0, 1), ("2024-01-30", "no2", 7.0, 1)]
    assert run((1, first, "no2", 20.0), (2, first, "no2", 40.0), (1, None, "no2", 1.0))[0] == ("2024-01-01", "no2", 30.0, 2)
    assert run((1, late, "no2", 3.0), (1, newest, "no2", None)) == [
        ("2024-01-01", "no2", 30.0, 2), ("2024-01-02", "no2", 3.0, 1), ("2024-01-30", "no2", None, 0),
    ]
    # a row that moves to another parameter leaves its old one
    assert run((1, late, "o3", 4.0))[1] == ("2024-01-02", "o3", 4.0, 1)
