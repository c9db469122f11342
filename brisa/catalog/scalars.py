"""Scalar functions and label rules, one query per function, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from brisa.bindings import COUNTRIES_AS_OF
from brisa.catalog.base import mean_sql, ratio_sql, register
from brisa.catalog.landing import location_records
from brisa.catalog.reports import _CATEGORY, _bands_sql, _region_sql, _who_sql
from brisa.functions import labels
from brisa.functions import scalars as fn

_SECONDS = "CAST(epoch(datetime_last) - epoch(datetime_first) AS BIGINT)"

Columns = Callable[[], list[Column]]


def _span() -> tuple[Column, Column]:
    return F.col("datetime_last"), F.col("datetime_first")


def _measured(key: str, sql: str, columns: Columns) -> None:
    register(key, lambda t: t.measurements().select("id", *columns()), f"SELECT id, {sql} FROM measurements")


def _located(key: str, sql: str, columns: Columns) -> None:
    register(
        key,
        lambda t: t.location_spans().select("location_id", *columns()),
        f"SELECT location_id, {sql} FROM locations",
    )


_measured(
    "fn_round",
    "CAST(round(value, 1) AS DOUBLE) AS rounded",
    lambda: [fn.fn_round(F.col("value"), 1).alias("rounded")],
)
_measured(
    "fn_cast",
    "CAST(round(value, 0) AS BIGINT) AS whole, CAST(sensor_id AS VARCHAR) AS text, "
    "CAST(CAST(sensor_id AS DECIMAL(10,2)) AS DOUBLE) AS number",
    lambda: [
        fn.fn_cast(F.round("value", 0), "bigint").alias("whole"),
        fn.fn_cast(F.col("sensor_id"), "string").alias("text"),
        fn.fn_cast(F.col("sensor_id"), "decimal(10,2)").alias("number"),
    ],
)
_measured(
    "fn_arith",
    "CAST(value - 25 AS DOUBLE) AS above, "
    "CAST(round((value - 25) * 4, 1) AS DOUBLE) AS percent, CAST(value * 2 AS DOUBLE) AS doubled, "
    "round((CAST(value AS DOUBLE) - 50) / 10, 4) AS z",
    lambda: [
        fn.difference(F.col("value"), F.lit(25)).alias("above"),
        fn.percent_over(F.col("value"), 25).alias("percent"),
        (F.col("value") * 2).alias("doubled"),
        F.round(fn.z_score(F.col("value"), F.lit(50), F.lit(10.0)), 4).alias("z"),
    ],
)
register(
    "fn_guarded_div",
    lambda t: t.countries().select("code", fn.guarded_div(F.col("locations"), F.col("sources") - 4).alias("per_source")),
    f"""SELECT code, CASE WHEN sources > 4 THEN {ratio_sql('locations', '(sources - 4)', 2)} ELSE 0 END AS per_source
        FROM countries""",
)
register(
    "fn_percent",
    lambda t: t.measurements().groupBy("sensor_id").agg(F.count_if("has_flags").alias("f"), F.count(F.lit(1)).alias("n"))
    .select("sensor_id", fn.percent_of(F.col("f"), F.col("n")).alias("percent")),
    f"""SELECT sensor_id, {ratio_sql('(count_if(has_flags) * 100)', 'count(*)', 1)} AS percent
        FROM measurements GROUP BY sensor_id""",
)
register(
    "fn_substr_year",
    lambda t: t.countries().select("code", fn.substr_year(F.col("datetimeFirst_raw")).alias("year")),
    'SELECT code, substr("datetimeFirst_raw", 1, 4) AS year FROM countries',
)
register(
    "fn_concat",
    lambda t: t.station("id", "sensor_id").select(fn.concat_key(F.col("id"), F.col("sensor_id")).alias("key")),
    "SELECT id || '-' || sensor_id AS key FROM station",
)
_located("fn_lower", "lower(name) AS lower_name", lambda: [F.lower("name").alias("lower_name")])
_measured(
    "fn_upper", "upper(parameter_name) AS upper_name", lambda: [F.upper("parameter_name").alias("upper_name")]
)
_measured("fn_date", "CAST(arrived_at AS DATE) AS day", lambda: [fn.date_of(F.col("arrived_at")).alias("day")])
_measured(
    "fn_extract",
    "CAST(year(arrived_at) AS BIGINT) AS year, CAST(hour(arrived_at) AS BIGINT) AS hour",
    lambda: [
        fn.year_of(F.col("arrived_at")).alias("year"),
        fn.hour_of(F.col("arrived_at")).alias("hour"),
    ],
)
_located(
    "fn_extract_day_interval", f"{_SECONDS} // 86400 AS days", lambda: [fn.whole_days(*_span()).alias("days")]
)
_located("fn_epoch_hours", f"{_SECONDS} / 3600.0 AS hours", lambda: [fn.epoch_hours(*_span()).alias("hours")])
_located(
    "fn_julian_days",
    f"CAST(round({_SECONDS} / 86400.0) AS BIGINT) AS days",
    lambda: [fn.julian_days(*_span()).alias("days")],
)
_located(
    "fn_interval_duration",
    f"{_SECONDS} AS seconds",
    lambda: [fn.duration(*_span()).cast("interval second").cast("bigint").alias("seconds")],
)
_NOW = datetime.fromisoformat(COUNTRIES_AS_OF)
_located(
    "fn_now",
    f"DATE '{_NOW:%Y-%m-%d}' AS today, TIMESTAMP '{COUNTRIES_AS_OF}' AS now, "
    f"CAST(epoch(TIMESTAMP '{COUNTRIES_AS_OF}') - epoch(datetime_last) AS BIGINT) // 86400 AS days_since",
    lambda: [
        F.lit(_NOW.date()).alias("today"),
        F.lit(COUNTRIES_AS_OF).cast("timestamp_ntz").alias("now"),
        fn.whole_days(F.lit(COUNTRIES_AS_OF).cast("timestamp_ntz"), F.col("datetime_last")).alias("days_since"),
    ],
)
_located(
    "fn_json_array_length",
    "CAST(json_array_length(sensors) AS BIGINT) AS n",
    lambda: [fn.json_length(F.col("sensors")).alias("n")],
)
register(
    "fn_json_elements_text",
    lambda t: t.locations().select("location_id", F.explode(fn.json_elements(F.col("sensors"))).alias("element")),
    """SELECT location_id, unnest(CAST(from_json(sensors, '["JSON"]') AS VARCHAR[])) AS element FROM locations""",
)
register(
    "fn_to_json",
    lambda t: t.station("id", "name", "locality").select("id", F.to_json(F.struct("name", "locality")).alias("json")),
    """SELECT id, '{"name":"' || name || '","locality":"' || locality || '"}' AS json FROM station""",
)
register(
    "fn_coalesce_default",
    lambda t: location_records(t).select(
        F.try_variant_get("record", "$.id", "bigint").alias("location_id"),
        fn.or_default(F.try_variant_get("record", "$.isMobile", "boolean"), False).alias("is_mobile"),
        fn.or_default(F.try_variant_get("record", "$.owner.name", "string"), "N/A").alias("owner"),
    ),
    """SELECT location_id, CASE WHEN location_id % 7 = 0 OR location_id % 11 = 0 THEN false ELSE is_mobile END AS is_mobile,
              CASE WHEN location_id % 13 = 0 THEN 'N/A' ELSE timezone END AS owner FROM locations""",
)
_HOUR_TEXT = "strftime(ts, '%Y-%m-%dT%H:00:00')"
register(
    "bucket_region",
    lambda t: t.table("events").select(
        "event_id", labels.bucket_region(F.date_format("ts", "yyyy-MM-dd'T'HH:'00:00'")).alias("region")
    ),
    f"SELECT event_id, {_region_sql(_HOUR_TEXT)} AS region FROM events",
)
register(
    "bucket_sensor",
    lambda t: t.table("part").select("p_partkey", labels.bucket_sensor(F.concat_ws(" ", "p_name", "p_type")).alias("category")),
    "SELECT p_partkey, " + _CATEGORY.format(x="(p_name || ' ' || p_type)") + " AS category FROM part",
)
_located(
    "bucket_quadrant",
    "CASE WHEN latitude >= -30 AND longitude >= -70 THEN 'Norte-Este' WHEN latitude >= -30 THEN 'Norte-Oeste' "
    "WHEN longitude >= -70 THEN 'Sur-Este' ELSE 'Sur-Oeste' END AS quadrant",
    lambda: [labels.bucket_quadrant(F.col("latitude"), F.col("longitude")).alias("quadrant")],
)
_measured(
    "band_pm25_excess",
    _bands_sql("value", labels.PM25_EXCESS_BANDS, labels.PM25_EXCESS_ELSE, ">") + " AS band",
    lambda: [labels.band_pm25_excess(F.col("value")).alias("band")],
)
_measured(
    "band_no2",
    _bands_sql("value", labels.NO2_BANDS, labels.NO2_ELSE, ">") + " AS band",
    lambda: [labels.band_no2(F.col("value")).alias("band")],
)
register(
    "band_who",
    lambda t: t.measurements().groupBy("sensor_id", "parameter_name").agg(F.round(F.avg("value"), 2).alias("mean_value"))
    .withColumn("rating", labels.band_who(F.col("parameter_name"), F.col("mean_value"))),
    f"""WITH means AS (SELECT sensor_id, parameter_name, {mean_sql('value', 2)} AS mean_value FROM measurements GROUP BY ALL)
        SELECT *, {_who_sql()} AS rating FROM means""",
)
_measured(
    "band_availability",
    _bands_sql("value / 100", labels.AVAILABILITY_BANDS, labels.AVAILABILITY_ELSE, ">=") + " AS band",
    lambda: [labels.band_availability(F.col("value") / 100).alias("band")],
)
