"""Landing files made from the tables: payload pages and lists, as a source would send them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.bindings import Model
from brisa.session import scratch_path

PAGE_SIZE = 1000


def measurement_pages(t: Model, records: DataFrame | None = None) -> DataFrame:
    """One line per page of a sensor.

    A page holds one sensor's events of a block of event ids, so it can never hold
    more than the page size, however many events the sensor has. Every third
    sensor reports its total as text that is no number.
    """
    records = t.measurement_records if records is None else records
    page = (F.floor(F.col("event_id") / PAGE_SIZE) + 1).cast("int")
    pages = records.groupBy("sensor_id", page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "json"))).alias("rows")
    )
    totals = records.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n"))
    found = F.when(F.col("sensor_id") % 3 == 0, F.lit(">1000")).otherwise(F.col("n").cast("string"))
    results = F.array_join(F.transform("rows", lambda r: r["json"]), ",")
    return pages.join(totals, "sensor_id").select(
        F.format_string(
            '{"sensor_id":%d,"meta":{"found":"%s","page":%d,"limit":%d},"results":[%s]}',
            "sensor_id", found, "page", F.lit(PAGE_SIZE), results,
        ).alias("value")
    )


def land_measurement_pages(t: Model) -> str:
    """Folder with one load run of pages."""
    path = scratch_path(t.spark, "landing")
    measurement_pages(t).write.text(f"{path}/run=2024-01-31")
    return path


def measurement_runs(t: Model) -> Iterator[str]:
    """Lands two load runs in one folder, which is given after each.

    The first has the pages of the lower half of the event ids, with wrong values. The second has all pages, which
    corrects the first, and those of sensors that are in no list: every tenth sensor again, under a negative id. It also has a cut page
    of every sensor.
    """
    path = scratch_path(t.spark, "landing")
    pages = F.floor(F.col("event_id") / PAGE_SIZE) + 1
    half = t.measurement_records.agg(F.floor((F.max(pages) + 1) / 2)).scalar()
    first = t.uncorrected_records.where(pages <= half)
    measurement_pages(t, first).write.text(f"{path}/run=1")
    yield path
    unlisted = t.measurement_records.where("sensor_id % 10 = 7").withColumn("sensor_id", -F.col("sensor_id"))
    page = '{"sensor_id":%d,"meta":{"found":"7","page":103,"limit":1000},"results":[{"value":1},{"val'
    cut = t.measurement_records.select("sensor_id").distinct().select(F.format_string(page, "sensor_id").alias("value"))
    measurement_pages(t, t.measurement_records.unionByName(unlisted)).union(cut).write.text(f"{path}/run=2")
    yield path


def sensor_list(t: Model) -> DataFrame:
    """The sensors whose pages are landed, with the location that owns each."""
    sensors = t.measurements().select("sensor_id", "location_id").distinct()
    names = t.locations().select("location_id", F.col("name").alias("location_name"))
    return sensors.join(names, "location_id", "left")


def tagged_records(t: Model) -> DataFrame:
    """Measurement records as text with their owner keys, without a detour over files."""
    names = t.locations().select("location_id", F.col("name").alias("location_name"))
    return t.measurement_records.join(names, "location_id", "left").select(
        "event_id", "sensor_id", "location_id", "location_name", "arrived_at",
        F.col("json").alias("record"),
    )


def country_records(t: Model) -> DataFrame:
    """Countries as payload: ids divisible by 5 have no list, by 7 a null list."""
    lists = (
        F.when(F.col("country_id") % 5 == 0, F.lit(""))
        .when(F.col("country_id") % 7 == 0, F.lit(',"parameters":null'))
        .otherwise(F.concat(F.lit(',"parameters":'), F.col("parameters")))
    )
    text = F.format_string(
        '{"id":%d,"code":"%s","name":"%s","datetimeFirst":"%sZ","datetimeLast":"%sZ"%s}',
        "country_id", "code", "name", "datetimeFirst_raw",
        F.date_format("datetimeLast", "yyyy-MM-dd'T'HH:mm:ss"), lists,
    )
    return t.countries().select(F.parse_json(text).alias("record"))


def location_records(t: Model) -> DataFrame:
    """Locations as payload: dates as text or object, flags absent or null in some."""
    spans = t.location_spans()
    day = F.date_format("datetime_first", "yyyy-MM-dd'T'HH:mm:ss")
    first = (
        F.when(F.col("datetime_first").isNull(), F.lit("null"))
        .when(F.col("location_id") % 2 == 0, F.format_string('"%sZ"', day))
        .otherwise(F.format_string('{"utc":"%sZ","local":"%s-04:00"}', day, day))
    )
    mobile = (
        F.when(F.col("location_id") % 7 == 0, F.lit(""))
        .when(F.col("location_id") % 11 == 0, F.lit(',"isMobile":null'))
        .otherwise(F.concat(F.lit(',"isMobile":'), F.col("is_mobile").cast("string")))
    )
    owner = F.when(F.col("location_id") % 13 == 0, F.lit("null")).otherwise(
        F.format_string('{"name":"%s"}', "timezone")
    )
    text = F.format_string(
        '{"id":%d,"name":"%s","locality":"%s","timezone":"%s","country":{"code":"%s","name":"%s"},'
        '"owner":%s,"provider":{"name":"%s"},"coordinates":{"latitude":%s,"longitude":%s}%s,'
        '"isMonitor":%s,"sensors":%s,"datetimeFirst":%s}',
        "location_id", "name", "locality", "timezone", "country_code", "country_name",
        owner, "locality", F.col("latitude").cast("string"), F.col("longitude").cast("string"),
        mobile, F.col("is_monitor").cast("string"), "sensors", first,
    )
    return spans.select(F.parse_json(text).alias("record"))


def parameter_records(t: Model) -> DataFrame:
    text = F.format_string(
        '{"id":%d,"name":"%s","displayName":"%s","units":"%s","description":null}',
        "parameter_id", "name", "display_name", "units",
    )
    return t.parameters().select(F.parse_json(text).alias("record"))


def country_pages(t: Model) -> DataFrame:
    """Country codes by page, as (code, page): each nation once per year it was ordered from.

    A code comes again on later pages, which is what the overlap check looks for.
    """
    nations = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("code"))
    customers = t.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (
        t.table("orders")
        .select("o_custkey", (F.year("o_orderdate") - 1994).cast("bigint").alias("page"))
        .join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .select("code", "page")
    )
