"""Fixed schemas of the model tables and of the landing payloads.

Timestamps carry no zone: a local wall clock must not move when the session
zone changes, so every one is ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


INT, BIGINT, STRING, BOOLEAN, DATE = (
    T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType(), T.DateType(),
)
NTZ = T.TimestampNTZType()
LATITUDE, LONGITUDE = T.DecimalType(10, 8), T.DecimalType(11, 8)
VALUE, PERCENT = T.DecimalType(15, 6), T.DecimalType(5, 2)


def _struct(required: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField(name, type_, name not in required) for name, type_ in columns.items()
    ])


@dataclass(frozen=True)
class Table:
    """Schema, natural key and partition columns of one model table."""

    schema: T.StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)


COUNTRIES = _struct(
    country_id=INT, code=STRING, name=STRING, datetimeFirst=NTZ, datetimeLast=NTZ,
    datetimeFirst_raw=STRING, datetimeLast_raw=STRING, parameters=STRING, locations=INT,
    sources=INT, extracted_at=NTZ,
)

LOCATIONS = _struct(
    location_id=INT, name=STRING, locality=STRING, timezone=STRING, country_code=STRING,
    country_name=STRING, owner_name=STRING, provider_name=STRING, is_mobile=BOOLEAN,
    is_monitor=BOOLEAN, latitude=LATITUDE, longitude=LONGITUDE, sensors=STRING,
    instruments=STRING, datetime_first=NTZ, datetime_last=NTZ, extracted_at=NTZ,
)

PARAMETERS = _struct(
    parameter_id=INT, name=STRING, display_name=STRING, units=STRING, description=STRING,
    extracted_at=NTZ,
)

MEASUREMENTS = _struct(
    required=("sensor_id",), sensor_id=INT, location_id=INT, value=VALUE, parameter_id=INT,
    parameter_name=STRING, parameter_units=STRING, datetime_utc=NTZ, datetime_local=NTZ,
    period_label=STRING, period_interval=STRING, period_from_utc=NTZ, period_to_utc=NTZ,
    period_from_local=NTZ, period_to_local=NTZ, has_flags=BOOLEAN, coordinates_latitude=LATITUDE,
    coordinates_longitude=LONGITUDE, coverage_expected_count=INT, coverage_observed_count=INT,
    coverage_percent_complete=PERCENT, coverage_percent_coverage=PERCENT, raw_data=STRING,
    extracted_at=NTZ, period_date=DATE,
)

STATION = _struct(
    required=("id", "sensor_id",), id=INT, name=STRING, locality=STRING, country_id=INT,
    provider_id=INT, provider_name=STRING, sensor_id=INT, sensor_name=STRING, latitude=LATITUDE,
    longitude=LONGITUDE, timezone=STRING, is_mobile=BOOLEAN, is_monitor=BOOLEAN,
    extracted_at=NTZ,
)

API_POSTS = _struct(
    id=INT, user_id=INT, title=STRING, body=STRING, extracted_at=NTZ,
)

DAG_RUNS = _struct(
    dt=DATE, dag_id=STRING,
)

TABLES: dict[str, Table] = {
    "countries": Table(COUNTRIES, ("country_id",), defaults={"locations": 0, "sources": 0}),
    "locations": Table(LOCATIONS, ("location_id",)),
    "parameters": Table(PARAMETERS, ("parameter_id",)),
    "measurements": Table(
        MEASUREMENTS,
        ("sensor_id", "period_from_utc", "period_to_utc"),
        ("period_date",),
        defaults={"has_flags": False},
    ),
    "station": Table(STATION, ("id", "sensor_id")),
    "api_posts": Table(API_POSTS, ("id",)),
    "dag_runs": Table(DAG_RUNS, ("dt", "dag_id"), ("dt", "dag_id")),
}

# When two records share a measurement key, these columns stay as they first arrived ...
MEASUREMENT_FIRST = (
    "location_id", "period_label", "period_interval",
    "period_from_local", "period_to_local",
    "coordinates_latitude", "coordinates_longitude",
)
# ... and these follow the newest record.
MEASUREMENT_LAST = (
    "value", "parameter_id", "parameter_name", "parameter_units",
    "datetime_utc", "datetime_local", "has_flags",
    "coverage_expected_count", "coverage_observed_count",
    "coverage_percent_complete", "coverage_percent_coverage",
    "raw_data", "extracted_at",
)

# ``found`` may be a number or text such as ">100", so it is read as text.
_META = _struct(found=STRING, page=INT, limit=INT)
_RESULTS = T.ArrayType(T.VariantType())
ENVELOPE = _struct(meta=_META, results=_RESULTS)
# Measurement pages are landed per load run (a folder ``run=...``) and sensor; their
# many records stay text until they are parsed once.
SENSOR_ENVELOPE = _struct(
    sensor_id=BIGINT, meta=_META, results=T.ArrayType(STRING), run=STRING
)
POST = _struct(
    id=INT, userId=INT, title=STRING, body=STRING,
)
DELIVERIES = _struct(
    product_id=INT, delivery_dt=DATE,
)
