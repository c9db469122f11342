"""Nested landing records to relational rows.

A key that is absent takes its default, a key that is present with null does not.
Records of the small tables are VARIANTs, which tell the two apart. Measurement
records stay JSON text: one parse reads all values, and a second one the keys of
the records that lack a part. The text itself is kept as ``raw_data``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = "record"


def _at(path: str, type_: str) -> Column:
    return F.try_variant_get(RECORD, f"$.{path}", type_)


def _part(path: str) -> Column:
    return F.try_variant_get(RECORD, f"$.{path}", "variant")


def _json_or_empty_list(path: str) -> Column:
    return F.coalesce(F.to_json(_part(path)), F.lit("[]"))


def _flag(path: str) -> Column:
    """False only if the key is absent."""
    return F.when(_part(path).isNull(), F.lit(False)).otherwise(_at(path, "boolean"))


def _ts(text: Column) -> Column:
    """Wall clock of an ISO text; an offset at its end does not move it."""
    return text.try_cast("timestamp_ntz")


def utc_or_text(path: str) -> Column:
    """A date that is either text or ``{utc, local}``: the utc, else the text of the object."""
    return F.coalesce(_at(f"{path}.utc", "string"), _at(path, "string"))


def flatten_countries(raw: DataFrame) -> DataFrame:
    first, last = _at("datetimeFirst", "string"), _at("datetimeLast", "string")
    return raw.select(
        _at("id", "int").alias("country_id"),
        _at("code", "string").alias("code"),
        _at("name", "string").alias("name"),
        _ts(first).alias("datetimeFirst"),
        _ts(last).alias("datetimeLast"),
        first.alias("datetimeFirst_raw"),
        last.alias("datetimeLast_raw"),
        _json_or_empty_list("parameters").alias("parameters"),
        *_carried(raw),
    )


def flatten_locations(raw: DataFrame) -> DataFrame:
    return raw.select(
        _at("id", "int").alias("location_id"),
        _at("name", "string").alias("name"),
        _at("locality", "string").alias("locality"),
        _at("timezone", "string").alias("timezone"),
        _at("country.code", "string").alias("country_code"),
        _at("country.name", "string").alias("country_name"),
        _at("owner.name", "string").alias("owner_name"),
        _at("provider.name", "string").alias("provider_name"),
        _flag("isMobile").alias("is_mobile"),
        _flag("isMonitor").alias("is_monitor"),
        _at("coordinates.latitude", "decimal(10,8)").alias("latitude"),
        _at("coordinates.longitude", "decimal(11,8)").alias("longitude"),
        _json_or_empty_list("sensors").alias("sensors"),
        _json_or_empty_list("instruments").alias("instruments"),
        _ts(utc_or_text("datetimeFirst")).alias("datetime_first"),
        _ts(utc_or_text("datetimeLast")).alias("datetime_last"),
        *_carried(raw),
    )


def flatten_parameters(raw: DataFrame) -> DataFrame:
    return raw.select(
        _at("id", "int").alias("parameter_id"),
        _at("name", "string").alias("name"),
        _at("displayName", "string").alias("display_name"),
        _at("units", "string").alias("units"),
        _at("description", "string").alias("description"),
        *_carried(raw),
    )


# A measurement record with every value as it is written. A part that is absent,
# null or no object is NULL in here.
_UTC_LOCAL = "struct<utc string, local string>"
_WRITTEN = (
    "struct<value string, parameter struct<id string, name string, units string>, "
    f"period struct<label string, interval string, datetimeFrom {_UTC_LOCAL}, datetimeTo {_UTC_LOCAL}>, "
    "coordinates struct<latitude string, longitude string>, "
    "coverage struct<expectedCount string, observedCount string, "
    "percentComplete string, percentCoverage string>, flagInfo struct<hasFlags string>>"
)
_KEYS = "map<string,string>"

# column -> (path in the record, type)
_MEASUREMENT = {
    "value": ("value", "decimal(15,6)"),
    "parameter_id": ("parameter.id", "int"),
    "parameter_name": ("parameter.name", "string"),
    "parameter_units": ("parameter.units", "string"),
    "period_label": ("period.label", "string"),
    "period_interval": ("period.interval", "string"),
    "period_from_utc": ("period.datetimeFrom.utc", "timestamp_ntz"),
    "period_to_utc": ("period.datetimeTo.utc", "timestamp_ntz"),
    "period_from_local": ("period.datetimeFrom.local", "timestamp_ntz"),
    "period_to_local": ("period.datetimeTo.local", "timestamp_ntz"),
    "coordinates_latitude": ("coordinates.latitude", "decimal(10,8)"),
    "coordinates_longitude": ("coordinates.longitude", "decimal(11,8)"),
    "coverage_expected_count": ("coverage.expectedCount", "int"),
    "coverage_observed_count": ("coverage.observedCount", "int"),
    "coverage_percent_complete": ("coverage.percentComplete", "decimal(5,2)"),
    "coverage_percent_coverage": ("coverage.percentCoverage", "decimal(5,2)"),
}
_FLAG = "flagInfo.hasFlags"


def _written(path: str) -> Column:
    return F.col(f"_written.{path}")


def _cast(path: str, type_: str) -> Column:
    """The written value in its column type, NULL if it does not fit."""
    text = _written(path)
    if type_ == "int":
        return F.round(text.try_cast("decimal(30,6)"), 0).try_cast("int")
    return text if type_ == "string" else text.try_cast(type_)


# What is asked for its key where it is NULL.
_ASKED = (
    "period", "period.datetimeFrom", "period.datetimeTo", "parameter", "coverage", "coordinates", "flagInfo", _FLAG,
)


def _lacks_a_part() -> Column:
    return reduce(Column.__or__, [_written(path).isNull() for path in _ASKED])


def _keys() -> Column:
    """Parts of the record as text. A second parse: read only where ``_lacks_a_part``."""
    return F.from_json(RECORD, _KEYS)


def _has_key(part: str, key: str) -> Column:
    """Is the key present in a part, be it with null? Read only where the value is NULL."""
    return F.map_contains_key(F.from_json(_keys()[part], _KEYS), key)


def parse_measurements(raw: DataFrame) -> DataFrame:
    """Adds the view ``_written`` (values) of the record.

    It comes out of a generator of one row: a projection would be merged with the
    filters and columns that use it, and each use would read the record again.
    """
    if "_written" in raw.columns:
        return raw
    if raw.schema[RECORD].dataType.simpleString() == "variant":
        raw = raw.withColumn(RECORD, F.to_json(RECORD))
    return raw.select("*", F.inline(F.array(F.struct(F.from_json(RECORD, _WRITTEN).alias("_written")))))


def flatten_measurements(raw: DataFrame) -> DataFrame:
    """Period, parameter, coverage and position as columns, the whole record as ``raw_data``.

    ``raw`` carries ``sensor_id``, ``location_id`` and ``location_name`` next to the
    record (see ``tag_context``); they become part of ``raw_data`` as well.
    """
    rows = parse_measurements(raw)
    columns = {name: _cast(path, type_) for name, (path, type_) in _MEASUREMENT.items()}
    flag = (
        F.when(_written(_FLAG).isNotNull(), _cast(_FLAG, "boolean"))
        .when(_has_key("flagInfo", "hasFlags"), F.lit(None))
        .otherwise(False)
    )
    return rows.select(
        "sensor_id",
        "location_id",
        *[column.alias(name) for name, column in columns.items()],
        F.lit(None).cast("timestamp_ntz").alias("datetime_utc"),
        F.lit(None).cast("timestamp_ntz").alias("datetime_local"),
        flag.alias("has_flags"),
        _record_with_context("sensor_id", "location_id", "location_name").alias("raw_data"),
        F.to_date(columns["period_from_utc"]).alias("period_date"),
        *_carried(rows),
    )


def _record_with_context(*names: str) -> Column:
    """The JSON object of the record with further keys at its end."""
    record = F.rtrim(RECORD)
    context = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    body = F.rtrim(F.substring(record, F.lit(1), F.length(record) - 1))
    joint = F.when(F.trim(body) == "{", F.lit("")).otherwise(F.lit(","))
    return F.concat(body, joint, F.substring(context, F.lit(2), F.length(context)))


def _carried(raw: DataFrame) -> list[Column]:
    """The arrival order goes along, because keyed loads need it, and so does a reject reason."""
    carried = [F.col("seq")] if "seq" in raw.columns else []
    if "reason" in raw.columns:
        rejected = F.when(F.col("reason").isNotNull(), F.col(RECORD))
        carried += [F.col("reason"), rejected.alias("rejected_record")]
    return carried


def flatten_posts(raw: DataFrame) -> DataFrame:
    """Every key is required: a record without one fails the load."""

    def required(name: str) -> Column:
        missing = F.raise_error(F.lit(f"post without {name}"))
        return F.when(F.col(name).isNull(), missing).otherwise(F.col(name))

    return raw.select(
        required("id").alias("id"),
        required("userId").alias("user_id"),
        required("title").alias("title"),
        required("body").alias("body"),
        *_carried(raw),
    )


def explode_sensors(locations: DataFrame) -> DataFrame:
    """One row per sensor of a location.

    Parameter name and units read 'N/A' where the key is absent. Sensors without
    an id (or with id 0) are dropped, and locations without sensors vanish.
    """

    def text(key: str) -> Column:
        found = F.try_variant_get("_sensor", f"$.parameter.{key}", "variant")
        value = F.try_variant_get("_sensor", f"$.parameter.{key}", "string")
        return F.when(found.isNull(), F.lit("N/A")).otherwise(value)

    sensor_id = F.try_variant_get("_sensor", "$.id", "bigint")
    return (
        locations.select(
            "location_id",
            F.col("name").alias("location_name"),
            F.explode(F.from_json("sensors", "array<variant>")).alias("_sensor"),
        )
        .select(
            sensor_id.alias("sensor_id"),
            "location_id",
            "location_name",
            text("name").alias("parameter_name"),
            text("units").alias("parameter_units"),
        )
        .where(F.coalesce(F.col("sensor_id"), F.lit(0)) != 0)
    )


def _kind(path: str) -> Column:
    """Schema text of the part: NULL if absent, VOID for null, ``OBJECT<...>`` for an object."""
    return F.schema_of_variant(_part(path))


def _no_object(path: str) -> Column:
    return F.coalesce(~_kind(path).startswith("OBJECT"), F.lit(False))


def _does_not_fit(path: str, type_: str) -> Column:
    """A value is there, but it is lost in its column type."""
    given = F.coalesce(_kind(path) != "VOID", F.lit(False))
    return given & _at(path, type_).isNull()


def _first_reason(rules: list[tuple[Column, str]]) -> Column:
    (test, reason), *rest = rules
    return reduce(lambda col, rule: col.when(rule[0], rule[1]), rest, F.when(test, reason))


def measurement_reject_reason(rows: DataFrame) -> Column:
    """Why a parsed record cannot be loaded: the first rule that it breaks.

    A part that is present must be an object, even if it is null; only no position at
    all is fine. A sensor must be named, and every value must fit its column.
    """
    rules = [(_lacks_a_part() & _keys().isNull(), "record is not an object")]
    rules += [
        (_written(part).isNull() & F.map_contains_key(_keys(), part), f"{part} is not an object")
        for part in ("period", "parameter", "coverage", "flagInfo")
    ]
    rules += [
        (_written(f"period.{end}").isNull() & _has_key("period", end), f"period.{end} is not an object")
        for end in ("datetimeFrom", "datetimeTo")
    ]
    position = _keys()["coordinates"]
    nothing = position.isin("false", "0", "", "[]")
    rules.append((_written("coordinates").isNull() & ~nothing, "coordinates is not an object"))
    rules.append((F.col("sensor_id").isNull(), "sensor_id is missing"))
    rules += [
        (_written(path).isNotNull() & _cast(path, type_).isNull(), f"{path} does not fit {type_}")
        for path, type_ in [*_MEASUREMENT.values(), (_FLAG, "boolean")]
        if type_ != "string"
    ]
    return _first_reason(rules)


def location_reject_reason(raw: DataFrame) -> Column:
    rules = [
        (_no_object(p), f"{p} is not an object")
        for p in ("country", "owner", "provider", "coordinates")
    ]
    rules += [
        (_does_not_fit("id", "int"), "id does not fit int"),
        (_does_not_fit("coordinates.latitude", "decimal(10,8)"), "latitude does not fit"),
        (_does_not_fit("coordinates.longitude", "decimal(11,8)"), "longitude does not fit"),
    ]
    return _first_reason(rules)


CUT_PAGE = "page is cut or malformed"


def with_reject_reason(raw: DataFrame, rule=measurement_reject_reason) -> DataFrame:
    """Adds ``reason``: why the record cannot be loaded, NULL if it can."""
    rows = parse_measurements(raw) if rule is measurement_reject_reason else raw
    reason = rule(rows)
    if "listed" in rows.columns:
        reason = F.when(F.col("listed").isNull(), "unknown sensor").otherwise(reason)
    if "unreadable" in rows.columns:
        reason = F.when(F.col("unreadable"), CUT_PAGE).otherwise(reason)
    return rows.withColumn("reason", reason)


def split_good_bad(raw: DataFrame, rule=measurement_reject_reason) -> tuple[DataFrame, DataFrame]:
    """Records to load, and records to set aside with their reason."""
    marked = with_reject_reason(raw, rule)
    return (
        marked.where(F.col("reason").isNull()).drop("reason"),
        marked.where(F.col("reason").isNotNull()),
    )
