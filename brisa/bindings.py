"""The model tables, derived from a star schema of orders and an event log.

Reports are written against the model; this module gives them large tables to run
on. Dimension columns are joined only if a report asks for them: the joins are LEFT
joins on unique keys, so leaving one out changes no row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.functions.aggregates import ROWS, combined_rows, combined_sides

# "Now" for the reports on events and on orders.
MEASUREMENTS_AS_OF = "2024-01-31 00:00:00"
COUNTRIES_AS_OF = "2001-08-02 00:00:00"

# event type -> parameter; every other type reads as so2
EVENT_PARAMETERS = {"click": "pm25", "view": "pm10", "purchase": "no2", "signup": "o3"}
OTHER_PARAMETER = "so2"

_PARAMETER_LISTS = ['["pm25","pm10","o3"]', '["pm25","no2"]', '["o3"]', "[]"]


def _latitude(key: str) -> Column:
    return (F.lit(-56) + (F.col(key) * 7919 % 3900) / 100.0).cast("decimal(10,8)")


def _longitude(key: str) -> Column:
    return (F.lit(-76) + (F.col(key) * 104729 % 900) / 100.0).cast("decimal(11,8)")


# Columns of the station table by the fact column that they hang on.
_STATION_KEYS = {
    "id": {"id", "name", "country_id", "locality", "timezone", "latitude", "longitude"},
    "sensor_id": {"sensor_id", "sensor_name", "provider_id", "provider_name"},
    "is_mobile": {"is_mobile"},
    "is_monitor": {"is_monitor"},
}

_schemas: dict[str, T.StructType] = {}


class Model:
    """Model tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        """A given table. Its schema is read from a file footer once per process."""
        path = self.path(name)
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def measurements(
        self, since: date | str | None = None, parameters: tuple[str, ...] | None = None
    ) -> DataFrame:
        """Events as measurements.

        ``since`` and ``parameters`` state on the raw columns what a report filters
        on the derived ones, so that the scan can skip row groups. A period starts
        at or before its event, so a bound on a day holds for the event too.
        """
        events = self.table("events")
        if since is not None:
            events = events.where(F.col("ts") >= F.lit(str(since)).cast("timestamp_ntz"))
        if parameters is not None:
            events = events.where(_is_event_of(parameters))
        return self.as_measurements(events)

    @staticmethod
    def as_measurements(events: DataFrame) -> DataFrame:
        """The event columns as measurement columns; for a batch or a stream."""
        return _as_measurements(events)

    def station(self, *columns: str, combined: bool = False, sides: bool = False) -> DataFrame:
        """One row per line item: a station (supplier) and its sensor (part).

        ``combined`` gives equal rows once, with their number (``combined_rows``). They are combined by the keys that the wanted
        columns hang on, before the dimensions are joined: only a report that asks for both sides meets (station, sensor) pairs.
        With ``sides`` not even that: stations and sensors are combined apart (``combined_sides``), for totals.
        """
        wanted = set(columns)
        rows = self.table("lineitem").select(
            F.col("l_suppkey").alias("id"),
            F.col("l_partkey").alias("sensor_id"),
            (F.col("l_returnflag") == "A").alias("is_mobile"),
            (F.col("l_linestatus") == "O").alias("is_monitor"),
            F.col("l_shipdate").alias("extracted_at"),
        )
        if combined or sides:
            keys = [key for key, hang in _STATION_KEYS.items() if wanted & hang]
            span = "extracted_at" if "extracted_at" in wanted else None
            rows = combined_sides(rows, keys, span) if sides else combined_rows(rows, keys, span)
            columns = (*columns, ROWS, *([f"last_{span}"] if span else []))
        if wanted & {"latitude", "longitude"}:
            rows = rows.withColumns({"latitude": _latitude("id"), "longitude": _longitude("id")})
        if wanted & {"name", "country_id", "locality", "timezone"}:
            supplier = self.table("supplier").select(
                F.col("s_suppkey").alias("id"),
                F.col("s_name").alias("name"),
                F.col("s_nationkey").alias("country_id"),
            )
            rows = rows.join(supplier, "id", "left")
        if wanted & {"locality", "timezone"}:
            # each dimension joins the rows directly: its own file size decides on a broadcast
            rows = rows.join(self._nation("country_id"), "country_id", "left")
        if wanted & {"provider_id", "provider_name", "sensor_name"}:
            part = self.table("part").select(
                F.col("p_partkey").alias("sensor_id"),
                F.col("p_size").alias("provider_id"),
                F.col("p_brand").alias("provider_name"),
                F.col("p_type").alias("sensor_name"),
            )
            rows = rows.join(part, "sensor_id", "left")
        return rows.select(*columns)

    def _nation(self, key: str) -> DataFrame:
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return nation.select(
            F.col("n_nationkey").alias(key),
            F.col("n_name").alias("locality"),
            F.col("r_name").alias("timezone"),
        )

    def countries(self) -> DataFrame:
        """Nations that have ordering customers, with the span of their orders.

        Orders are reduced per customer before the join, and customers per nation
        after it. Suppliers count as sources, none counts 0.
        """
        per_customer = self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
        )
        per_nation = (
            self.table("customer")
            .join(per_customer, "c_custkey")
            .groupBy(F.col("c_nationkey").alias("n_nationkey"))
            .agg(
                F.min("first_order").alias("datetimeFirst"),
                F.max("last_order").alias("datetimeLast"),
                F.count(F.lit(1)).alias("locations"),
            )
        )
        suppliers = self.table("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
            F.count(F.lit(1)).alias("sources")
        )
        lists = F.array(*[F.lit(text) for text in _PARAMETER_LISTS])
        return (
            self.table("nation")
            .join(per_nation, "n_nationkey")
            .join(suppliers, "n_nationkey", "left")
            .select(
                F.col("n_nationkey").alias("country_id"),
                F.col("n_name").alias("code"),
                F.col("n_name").alias("name"),
                "datetimeFirst",
                "datetimeLast",
                F.date_format("datetimeFirst", "yyyy-MM-dd'T'HH:mm:ss").alias("datetimeFirst_raw"),
                F.get(lists, F.col("n_nationkey") % len(_PARAMETER_LISTS)).alias("parameters"),
                "locations",
                F.coalesce("sources", F.lit(0).cast("bigint")).alias("sources"),
                F.col("datetimeLast").alias("extracted_at"),
            )
        )

    def locations(self) -> DataFrame:
        customer = self.table("customer")
        nation = self._nation("c_nationkey").withColumnRenamed("locality", "n_name")
        first, second = (F.col("c_custkey") * 10).cast("string"), (F.col("c_custkey") * 10 + 1).cast("string")
        pm25 = F.lit(',"parameter":{"name":"pm25","units":"ug/m3"}},{"id":')
        ozone = F.lit(',"parameter":{"name":"o3","units":"ppm"}},{"parameter":{"name":"no2","units":"ppb"}}]')
        sensors = (
            F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('[{"id":'), first, pm25, second, F.lit("}]")))
            .when(F.col("c_custkey") % 3 == 1, F.lit("[]"))
            .otherwise(F.concat(F.lit('[{"id":'), first, ozone))
        )
        return customer.join(nation, "c_nationkey", "left").select(
            F.col("c_custkey").alias("location_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("locality"),
            "timezone",
            F.col("n_name").alias("country_code"),
            F.col("n_name").alias("country_name"),
            (F.col("c_acctbal") < 0).alias("is_mobile"),
            (F.col("c_custkey") % 2 == 0).alias("is_monitor"),
            _latitude("c_custkey").alias("latitude"),
            _longitude("c_custkey").alias("longitude"),
            sensors.alias("sensors"),
        )

    def location_spans(self) -> DataFrame:
        """Locations with the first and last order of the customer, and its load time.

        A customer without orders has no dates.
        """
        spans = self.table("orders").groupBy(F.col("o_custkey").alias("location_id")).agg(
            F.min("o_orderdate").alias("datetime_first"),
            F.max("o_orderdate").alias("datetime_last"),
        )
        return (
            self.locations()
            .join(spans, "location_id", "left")
            .withColumn("extracted_at", F.col("datetime_last"))
        )

    def parameters(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("parameter_id"),
            F.col("p_type").alias("name"),
            F.col("p_name").alias("display_name"),
            F.col("p_brand").alias("units"),
        )

    def raw_posts(self) -> DataFrame:
        """Conversation turns in the shape of the posts payload."""
        return self.table("conversations").select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
            F.col("conv_id").alias("userId"),
            F.col("role").alias("title"),
            F.col("text").alias("body"),
        )

    @property
    def measurement_records(self) -> DataFrame:
        """Events in the shape of the measurement payload, one JSON text each.

        Some records lack a part, and some have null in its place: see the CASEs.
        """
        return _as_payload(self.table("events"))

    @property
    def uncorrected_records(self) -> DataFrame:
        """The same records with values that a later run corrects."""
        return _as_payload(self.table("events").withColumn("value", F.col("value") - 5))


def _is_event_of(parameters: tuple[str, ...]) -> Column:
    types = [t for t, p in EVENT_PARAMETERS.items() if p in parameters]
    test = F.col("event_type").isin(types)
    if OTHER_PARAMETER in parameters:
        test = test | ~F.col("event_type").isin(list(EVENT_PARAMETERS))
    return test


def hour_start(ts: str) -> Column:
    """Start of the hour of a zone-less timestamp, without a detour over the session zone."""
    return F.expr(f"{ts} - make_dt_interval(0, 0, minute({ts}), extract(SECOND FROM {ts}))")


def parameter_of(event_type: str) -> Column:
    rules = F.when(F.lit(False), F.lit(None).cast("string"))
    for type_, parameter in EVENT_PARAMETERS.items():
        rules = rules.when(F.col(event_type) == type_, parameter)
    return rules.otherwise(OTHER_PARAMETER)


def _as_measurements(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("sensor_id"),
        (F.col("user_id") % 25).alias("location_id"),
        parameter_of("event_type").alias("parameter_name"),
        F.lit("ug/m3").alias("parameter_units"),
        F.col("value").cast("decimal(15,6)").alias("value"),
        hour_start("ts").alias("period_from_utc"),
        (hour_start("ts") + F.expr("INTERVAL '1' HOUR")).alias("period_to_utc"),
        F.col("event_type").alias("period_label"),
        (F.col("value") > 200).alias("has_flags"),
        F.col("props").alias("raw_data"),
        F.col("ts").alias("arrived_at"),
    )


def _as_payload(events: DataFrame) -> DataFrame:
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    start = F.date_format(hour_start("ts"), iso)
    end = F.date_format(hour_start("ts") + F.expr("INTERVAL '1' HOUR"), iso)
    span = F.format_string(
        '{"label":"%s","interval":"01:00:00",'
        '"datetimeFrom":{"utc":"%sZ","local":"%s-04:00"},"datetimeTo":{"utc":"%sZ","local":"%s-04:00"}}',
        F.col("event_type"), start, start, end, end,
    )
    part = F.col("event_id") % 20
    coverage = F.when(part == 1, F.lit(',"coverage":null')).when(part == 2, F.lit("")).otherwise(
        F.lit(',"coverage":{"expectedCount":1,"observedCount":1,"percentComplete":100.0,"percentCoverage":100.0}')
    )
    position = F.when(part == 3, F.lit(',"coordinates":null')).otherwise(
        F.lit(',"coordinates":{"latitude":-33.45,"longitude":-70.66}')
    )
    flags = F.when(part == 4, F.lit("")).otherwise(
        F.concat(F.lit(',"flagInfo":{"hasFlags":'), (F.col("value") > 200).cast("string"), F.lit("}"))
    )
    value = F.when(part == 5, F.lit('"n/a"')).otherwise(
        F.col("value").cast("decimal(15,6)").cast("string")
    )
    record = F.concat(
        F.lit('{"value":'), value,
        F.lit(',"parameter":{"id":1,"name":"'), parameter_of("event_type"), F.lit('","units":"ug/m3"},"period":'),
        span, coverage, position, flags, F.lit("}"),
    )
    return events.select(
        F.col("event_id"),
        F.col("user_id").alias("sensor_id"),
        (F.col("user_id") % 25).alias("location_id"),
        F.col("ts").alias("arrived_at"),
        record.alias("json"),
    )
