"""Sources, sinks, flattening, keyed loads, streams and page checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import schemas
from brisa.bindings import MEASUREMENTS_AS_OF, Model
from brisa.catalog import landing
from brisa.catalog.base import mean_sql, query, register
from brisa.operators import flatten, loads
from brisa.operators.metrics import concat_pages
from brisa.plans import countries, paging, quality
from brisa.session import as_written_table, scratch_path
from brisa.sources import files, tables
from brisa.streaming import ingest

KEY = ["sensor_id", "period_from_utc", "period_to_utc"]
FIRST = ["location_id", "period_label"]
LAST = ["value", "parameter_name", "has_flags", "raw_data"]
SEQ = ["arrived_at", "id"]
_POSITION = "CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude"

# --- sources and sinks --------------------------------------------------------


@query(
    "scan_table",
    """SELECT CAST(parameter_id AS INTEGER) AS parameter_id, name, display_name, units,
              CAST(NULL AS VARCHAR) AS description, CAST(NULL AS TIMESTAMP) AS extracted_at FROM parameters""",
)
def _(t: Model) -> DataFrame:
    base = scratch_path(t.spark, "model")
    aligned = loads.align_schema(t.parameters(), schemas.PARAMETERS)
    tables.publish(aligned, f"{base}/parameters")
    return tables.read_table(t.spark, "parameters", base)


def _envelopes(t: Model) -> DataFrame:
    path = landing.land_measurement_pages(t)
    return files.read_envelopes(t.spark, path, schemas.SENSOR_ENVELOPE, multi_line=False)


_FOUND = "CASE WHEN sensor_id % 3 = 0 THEN '>1000' ELSE CAST(count(*) OVER (PARTITION BY sensor_id) AS VARCHAR) END"

register(
    "scan_envelope",
    lambda t: _envelopes(t).select(
        "sensor_id", F.col("page").cast("bigint"), "found", F.col("limit").cast("bigint"),
        F.col("seq.pos").cast("bigint").alias("pos"),
        F.get_json_object("record", "$.parameter.name").alias("parameter_name"),
        F.get_json_object("record", "$.period.label").alias("label"),
    ),
    f"""SELECT sensor_id, page, {_FOUND} AS found, CAST(1000 AS BIGINT) AS "limit", pos, parameter_name,
               event_type AS label FROM records""",
)

register(
    "tag_context",
    lambda t: files.tag_context(_envelopes(t), as_written_table(landing.sensor_list(t), "sensors")).select(
        "sensor_id", "location_id", "location_name", F.col("page").cast("bigint"),
        F.col("seq.pos").cast("bigint").alias("pos"),
    ),
    """SELECT r.sensor_id, r.location_id, l.name AS location_name, page, pos
       FROM records r LEFT JOIN locations l ON l.location_id = r.location_id""",
)

register(
    "concat_pages",
    lambda t: concat_pages(
        t.station("id", "name", "locality", "sensor_id").select("id", "name", "locality"),
        t.locations().select(F.col("location_id").alias("id"), "name", "country_code"),
    ),
    """SELECT id, name, locality, NULL AS country_code FROM station
       UNION ALL SELECT location_id, name, NULL, country_code FROM locations""",
)

_POST_BIG = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("userId", T.LongType()),
    T.StructField("title", T.StringType()), T.StructField("body", T.StringType()),
])


@query("scan_json_list", "SELECT id, user_id AS \"userId\", title, body FROM posts")
def _(t: Model) -> DataFrame:
    path = scratch_path(t.spark, "posts")
    files.write_json(t.raw_posts(), path)
    return files.read_json_list(t.spark, path, _POST_BIG, multi_line=False)


@query("scan_csv", "SELECT o_orderkey AS product_id, CAST(o_orderdate AS DATE) AS delivery_dt FROM orders")
def _(t: Model) -> DataFrame:
    path = scratch_path(t.spark, "deliveries")
    rows = t.table("orders").select(
        F.col("o_orderkey").alias("product_id"),
        F.date_format("o_orderdate", " yyyy-MM-dd").alias(" delivery_dt"),
    )
    # a blank after each comma, in the header as in the values
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    schema = T.StructType([
        T.StructField("product_id", T.LongType()), T.StructField("delivery_dt", T.DateType()),
    ])
    return files.read_csv(t.spark, path, schema)


_LOCATION_CSV = T.StructType([
    T.StructField("location_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("country_code", T.StringType()), T.StructField("latitude", schemas.LATITUDE),
    T.StructField("longitude", schemas.LONGITUDE),
])


@query("sink_csv", f"SELECT location_id, name, country_code, {_POSITION} FROM locations")
def _(t: Model) -> DataFrame:
    path = scratch_path(t.spark, "locations-csv")
    files.write_csv(t.locations().select(_LOCATION_CSV.names), path)
    return files.read_csv(t.spark, path, _LOCATION_CSV)


@query(
    "lc_export",
    """SELECT country_id, code, name, "datetimeFirst", "datetimeLast", parameters, locations, sources FROM countries""",
)
def _(t: Model) -> DataFrame:
    columns = ["country_id", "code", "name", "datetimeFirst", "datetimeLast", "parameters", "locations", "sources"]
    c = t.countries().select(columns)
    path = countries.lc_export(c, scratch_path(t.spark, "countries-csv"))
    return t.spark.read.schema(c.schema).option("header", True).option("escape", "\\").csv(path)


_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"""


@query("sink_slice", f"{_ORDERS_SQL} WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'")
def _(t: Model) -> DataFrame:
    base = scratch_path(t.spark, "orders")
    orders = t.table("orders")
    start = date(1997, 1, 1)
    files.export_slice(orders, "o_orderdate", start, date(1998, 1, 1), base)
    files.export_slice(orders, "o_orderdate", start, date(1998, 1, 1), base)
    return files.read_exported_day(t.spark, base, start, orders.schema)


@query("sink_slice_days", "SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n FROM events GROUP BY ALL")
def _(t: Model) -> DataFrame:
    base = scratch_path(t.spark, "event-days")
    events = t.table("events").drop("props")
    files.export_days(events, "ts", date(2000, 1, 1), date(2100, 1, 1), base)
    schema = T.StructType([*events.schema.fields, T.StructField("dt", T.StringType())])
    exported = t.spark.read.schema(schema).option("header", True).csv(base)
    return exported.groupBy("dt").agg(F.count("event_id").alias("n"))


@query("sink_json", "SELECT location_id, name, country_code, is_mobile FROM locations")
def _(t: Model) -> DataFrame:
    path = scratch_path(t.spark, "locations-json")
    rows = t.locations().select("location_id", "name", "country_code", "is_mobile")
    files.write_json(rows, path)
    return files.read_json_list(t.spark, path, rows.schema, multi_line=False)


@query(
    "sink_summary_json",
    """SELECT '2024-01-31T00:00:00' AS execution_time, (SELECT count(*) FROM countries) AS total_countries,
              'América/Otros' AS region, count(*) AS countries, 'orders' AS data_source FROM countries""",
)
def _(t: Model) -> DataFrame:
    path = scratch_path(t.spark, "summary")
    report = countries.summary_report(t.countries(), "2024-01-31T00:00:00", "orders", "")
    files.write_json(report, path)
    read = files.read_json_list(t.spark, path, report.schema, multi_line=False)
    return read.select(
        "execution_time", "total_countries", "data_source",
        F.explode("regional_distribution").alias("region", "countries"),
    )


@query(
    "create_table",
    """SELECT 'countries' AS table_name, true AS present, count(*) AS rows FROM countries
       UNION ALL SELECT 'locations', true, count(*) FROM locations
       UNION ALL SELECT 'parameters', true, count(*) FROM parameters
       UNION ALL SELECT 'measurements', true, CAST(0 AS BIGINT)
       UNION ALL SELECT 'station', true, count(*) FROM station
       UNION ALL SELECT 'api_posts', true, CAST(0 AS BIGINT)
       UNION ALL SELECT 'dag_runs', true, CAST(0 AS BIGINT)""",
)
def _(t: Model) -> DataFrame:
    """Create all tables, create them again (nothing happens), fill four of them, count all."""
    base = scratch_path(t.spark, "model")
    tables.ensure_tables(t.spark, base)
    content = {
        "countries": t.countries(),
        "locations": t.locations(),
        "parameters": t.parameters(),
        "station": t.station("id", "name", "sensor_id", "latitude", "longitude"),
    }
    for name, df in content.items():
        table = schemas.TABLES[name]
        tables.publish(loads.align_schema(df, table.schema, table.defaults), f"{base}/{name}")
    if tables.ensure_tables(t.spark, base):
        raise AssertionError("tables were created twice")
    found = {name: tables.read_table(t.spark, name, base) for name in schemas.TABLES}
    return tables.inventory(t.spark, found)


_INVENTORY = ("customer", "orders", "part", "supplier")

register(
    "table_inventory",
    lambda t: tables.inventory(t.spark, tables.open_tables(t.spark, t.folder, [*_INVENTORY, "station"])),
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, true AS present, count(*) AS rows FROM {n}" for n in _INVENTORY)
    + " UNION ALL SELECT 'sta' || 'tion', false, CAST(0 AS BIGINT)",
)


@query(
    "best_snapshot",
    """SELECT 'second' AS snapshot, CAST((SELECT count(*) FROM orders) + (SELECT count(*) FROM part) AS BIGINT) AS total_rows""",
)
def _(t: Model) -> DataFrame:
    listed = {"first": ["customer", "supplier", "absent"], "second": ["orders", "part"], "third": ["absent"]}
    found = [
        tables.inventory(t.spark, tables.open_tables(t.spark, t.folder, names), snapshot).withColumn(
            "ordinal", F.lit(i)
        )
        for i, (snapshot, names) in enumerate(listed.items())
    ]
    return tables.best_snapshot(concat_pages(*found))


# --- flattening ---------------------------------------------------------------

register(
    "flatten_countries",
    lambda t: flatten.flatten_countries(landing.country_records(t)).withColumn(
        "country_id", F.col("country_id").cast("bigint")
    ),
    """SELECT CAST(country_id AS BIGINT) AS country_id, code, name, "datetimeFirst", "datetimeLast",
              "datetimeFirst_raw" || 'Z' AS "datetimeFirst_raw",
              strftime("datetimeLast", '%Y-%m-%dT%H:%M:%SZ') AS "datetimeLast_raw",
              CASE WHEN country_id % 5 = 0 THEN '[]' WHEN country_id % 7 = 0 THEN 'null' ELSE parameters END AS parameters
       FROM countries""",
)

_FLAT_LOCATION = f"""location_id, name, locality, timezone, country_code, country_name, timezone AS owner_name,
    locality AS provider_name,
    CASE WHEN location_id % 7 = 0 THEN false WHEN location_id % 11 = 0 THEN NULL ELSE is_mobile END AS is_mobile,
    is_monitor, {_POSITION}, sensors, '[]' AS instruments, datetime_first, CAST(NULL AS TIMESTAMP) AS datetime_last"""

register(
    "flatten_locations",
    lambda t: flatten.flatten_locations(
        flatten.split_good_bad(landing.location_records(t), flatten.location_reject_reason)[0]
    ).withColumn("location_id", F.col("location_id").cast("bigint")),
    f"SELECT {_FLAT_LOCATION} FROM locations WHERE location_id % 13 <> 0",
)

register(
    "string_or_struct_ts",
    lambda t: landing.location_records(t).select(
        F.try_variant_get("record", "$.id", "bigint").alias("location_id"),
        flatten.utc_or_text("datetimeFirst").alias("first_text"),
    ),
    """SELECT location_id, strftime(datetime_first, '%Y-%m-%dT%H:%M:%SZ') AS first_text FROM locations""",
)

register(
    "flatten_parameters",
    lambda t: flatten.flatten_parameters(landing.parameter_records(t)).withColumn(
        "parameter_id", F.col("parameter_id").cast("bigint")
    ),
    "SELECT parameter_id, name, display_name, units, CAST(NULL AS VARCHAR) AS description FROM parameters",
)

# records without coverage (2), without flags (4), without position (3); 1 and 5 are rejected
_FLAT_MEASUREMENT = """sensor_id, location_id, CAST(value AS DOUBLE) AS value, CAST(1 AS BIGINT) AS parameter_id,
    parameter_name, 'ug/m3' AS parameter_units, event_type AS period_label, '01:00:00' AS period_interval,
    hour AS period_from_utc, hour + INTERVAL 1 HOUR AS period_to_utc,
    hour AS period_from_local, hour + INTERVAL 1 HOUR AS period_to_local,
    CASE WHEN part = 3 THEN NULL ELSE -33.45 END::DOUBLE AS coordinates_latitude,
    CASE WHEN part = 3 THEN NULL ELSE -70.66 END::DOUBLE AS coordinates_longitude,
    CASE WHEN part = 2 THEN NULL ELSE 1 END::BIGINT AS coverage_expected_count,
    CASE WHEN part = 2 THEN NULL ELSE 100 END::DOUBLE AS coverage_percent_complete,
    part <> 4 AND value > 200 AS has_flags, CAST(hour AS DATE) AS period_date, sensor_id AS raw_sensor"""

_FLAT_COLUMNS = [
    "sensor_id", "location_id", "value", "parameter_name", "parameter_units", "period_label", "period_interval",
    "period_from_utc", "period_to_utc", "period_from_local", "period_to_local", "coordinates_latitude",
    "coordinates_longitude", "coverage_percent_complete", "has_flags", "period_date",
]

register(
    "flatten_measurements",
    lambda t: flatten.flatten_measurements(flatten.split_good_bad(landing.tagged_records(t))[0]).select(
        *_FLAT_COLUMNS,
        F.col("parameter_id").cast("bigint"),
        F.col("coverage_expected_count").cast("bigint"),
        F.get_json_object("raw_data", "$.sensor_id").cast("bigint").alias("raw_sensor"),
    ),
    f"SELECT {_FLAT_MEASUREMENT} FROM records WHERE part NOT IN (1, 5)",
)

register(
    "flatten_posts",
    lambda t: flatten.flatten_posts(t.raw_posts()),
    "SELECT id, user_id, title, body FROM posts",
)

register(
    "explode_sensors",
    lambda t: flatten.explode_sensors(t.locations()),
    """SELECT * FROM (
         SELECT location_id * 10 AS sensor_id, location_id, name AS location_name,
                CASE location_id % 3 WHEN 0 THEN 'pm25' ELSE 'o3' END AS parameter_name,
                CASE location_id % 3 WHEN 0 THEN 'ug/m3' ELSE 'ppm' END AS parameter_units
         FROM locations WHERE location_id % 3 <> 1
         UNION ALL SELECT location_id * 10 + 1, location_id, name, 'N/A', 'N/A' FROM locations WHERE location_id % 3 = 0)
       WHERE sensor_id <> 0""",
)

register(
    "quarantine",
    lambda t: flatten.split_good_bad(landing.tagged_records(t))[1].select("event_id", "sensor_id", "reason"),
    """SELECT event_id, sensor_id, CASE part WHEN 1 THEN 'coverage is not an object'
                                             ELSE 'value does not fit decimal(15,6)' END AS reason
       FROM records WHERE part IN (1, 5)""",
)

# --- keyed loads --------------------------------------------------------------

_ROWS = [*KEY, *FIRST, *LAST, *SEQ]
_LAST_SQL = """
    SELECT * EXCLUDE (rn, arrived_at, id, parameter_units, value), CAST(value AS DOUBLE) AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY sensor_id, period_from_utc, period_to_utc
                                   ORDER BY arrived_at DESC, id DESC) AS rn FROM measurements)
    WHERE rn = 1"""


def _half_hours(t: Model) -> tuple[DataFrame, DataFrame]:
    """The measurements in two loads: those of the first half of each hour, then the others."""
    m = t.measurements().select(_ROWS).withColumn("period_date", F.to_date("period_from_utc"))
    early = F.minute("arrived_at") < 30
    return m.where(early), m.where(~early)


@query("full_refresh", _LAST_SQL)
def _(t: Model) -> DataFrame:
    """A first load of some rows is replaced as a whole by the second."""
    target = scratch_path(t.spark, "refreshed")
    rows = t.measurements().select(_ROWS)
    loads.full_refresh(target, _half_hours(t)[0].select(_ROWS), KEY, SEQ)
    return loads.full_refresh(target, rows, KEY, SEQ)


@query("full_refresh_unique", "SELECT id, user_id, title, body FROM posts")
def _(t: Model) -> DataFrame:
    posts = flatten.flatten_posts(t.raw_posts()).withColumn("seq", F.col("id"))
    return loads.full_refresh(scratch_path(t.spark, "posts"), posts, ["id"], ["seq"], on_duplicate="fail")


@query("upsert_last", _LAST_SQL)
def _(t: Model) -> DataFrame:
    target = scratch_path(t.spark, "upserted")
    for half in _half_hours(t):
        result = loads.upsert(target, half.select(_ROWS), KEY, SEQ)
    return result


@query(
    "upsert_first_last",
    """SELECT sensor_id, period_from_utc, period_to_utc, CAST(period_from_utc AS DATE) AS period_date,
              arg_min(location_id, (arrived_at, id)) AS location_id, arg_min(period_label, (arrived_at, id)) AS period_label,
              CAST(arg_max(value, (arrived_at, id)) AS DOUBLE) AS value,
              arg_max(parameter_name, (arrived_at, id)) AS parameter_name,
              arg_max(has_flags, (arrived_at, id)) AS has_flags, arg_max(raw_data, (arrived_at, id)) AS raw_data
       FROM measurements GROUP BY ALL""",
)
def _(t: Model) -> DataFrame:
    target = scratch_path(t.spark, "measurements")
    for half in _half_hours(t):
        result = loads.upsert_partial(target, half, KEY, FIRST, LAST, SEQ)
    return result


_FLAGGED_HOLES = "CASE WHEN has_flags THEN NULL ELSE period_to_utc END"


@query(
    "null_key_passthrough",
    f"""WITH holes AS (SELECT sensor_id, period_from_utc, {_FLAGGED_HOLES} AS period_to_utc, value, arrived_at, id FROM measurements),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY sensor_id, period_from_utc, period_to_utc
                                                  ORDER BY arrived_at DESC, id DESC) AS rn FROM holes)
        SELECT sensor_id, period_from_utc, period_to_utc, CAST(value AS DOUBLE) AS value
        FROM numbered WHERE rn = 1 OR period_to_utc IS NULL""",
)
def _(t: Model) -> DataFrame:
    holes = F.when(~F.col("has_flags"), F.col("period_to_utc"))
    rows = t.measurements().select(*KEY, "value", "has_flags", *SEQ).withColumn("period_to_utc", holes)
    return loads.upsert(scratch_path(t.spark, "holes"), rows.drop("has_flags"), KEY, SEQ)


@query("day_replace", "SELECT CAST(ts AS DATE) AS dt, event_type AS dag_id, count(*) AS n FROM events GROUP BY ALL")
def _(t: Model) -> DataFrame:
    """Rows of a first load with wrong counts are replaced; loading again changes nothing."""
    target = scratch_path(t.spark, "runs")
    runs = t.table("events").groupBy(F.to_date("ts").alias("dt"), F.col("event_type").alias("dag_id"))
    right = as_written_table(runs.agg(F.count(F.lit(1)).alias("n")), "runs")
    loads.day_replace(target, right.withColumn("n", F.lit(-1).cast("bigint")), ["dt", "dag_id"], "dt")
    loads.day_replace(target, right, ["dt", "dag_id"], "dt")
    return loads.day_replace(target, right, ["dt", "dag_id"], "dt").select("dt", "dag_id", "n")


register(
    "load_stamp",
    lambda t: loads.stamp(t.locations(), MEASUREMENTS_AS_OF).select("location_id", "extracted_at"),
    f"SELECT location_id, TIMESTAMP '{MEASUREMENTS_AS_OF}' AS extracted_at FROM locations",
)

register(
    "positional_default",
    lambda t: loads.align_schema(
        t.countries().drop("locations", "sources", "extracted_at"),
        schemas.COUNTRIES, schemas.TABLES["countries"].defaults,
    ).select("country_id", "code", "datetimeLast", "datetimeLast_raw", "locations", "sources", "extracted_at"),
    """SELECT CAST(country_id AS INTEGER) AS country_id, code, "datetimeLast", CAST(NULL AS VARCHAR) AS "datetimeLast_raw",
              CAST(0 AS INTEGER) AS locations, CAST(0 AS INTEGER) AS sources, CAST(NULL AS TIMESTAMP) AS extracted_at
       FROM countries""",
)


@query(
    "v_validate_posts",
    f"""SELECT count(*) AS rows, count(DISTINCT user_id) AS users, TIMESTAMP '{MEASUREMENTS_AS_OF}' AS first_load,
               TIMESTAMP '{MEASUREMENTS_AS_OF}' AS last_load FROM posts""",
)
def _(t: Model) -> DataFrame:
    posts = loads.stamp(flatten.flatten_posts(t.raw_posts()), MEASUREMENTS_AS_OF)
    return quality.v_validate_posts(posts)


# --- streams ------------------------------------------------------------------

_GOOD = "SELECT * FROM records WHERE part NOT IN (1, 5)"


def _ingested(t: Model) -> dict[str, str]:
    """Both landed runs loaded, one after the other; the folders of the landing, the table, the rejected records and the counts."""
    at = {n: scratch_path(t.spark, n) for n in ("measurements", "rejected", "loaded")}
    state = scratch_path(t.spark, "stream")
    sensors = as_written_table(landing.sensor_list(t), "sensors")
    for at["landing"] in landing.measurement_runs(t):
        pages = files.stream_pages(t.spark, at["landing"], multi_line=False)
        ingest.incremental_ingest(
            pages, sensors, at["measurements"], state, MEASUREMENTS_AS_OF, at["rejected"], at["loaded"]
        ).awaitTermination()
    return at


@query(
    "incremental_ingest",
    f"""WITH good AS ({_GOOD})
        SELECT sensor_id, hour AS period_from_utc, hour + INTERVAL 1 HOUR AS period_to_utc,
               arg_min(event_type, event_id) AS period_label, arg_min(location_id, event_id) AS location_id,
               arg_max(parameter_name, event_id) AS parameter_name, CAST(arg_max(value, event_id) AS DOUBLE) AS value,
               arg_max(part <> 4 AND value > 200, event_id) AS has_flags,
               TIMESTAMP '{MEASUREMENTS_AS_OF}' AS extracted_at
        FROM good GROUP BY sensor_id, hour""",
)
def _(t: Model) -> DataFrame:
    return t.spark.read.parquet(_ingested(t)["measurements"]).select(
        *KEY, "period_label", "location_id", "parameter_name", "value", "has_flags", "extracted_at"
    )


@query(
    "incremental_ingest_counts",
    """WITH half AS (SELECT (max(page) + 1) // 2 AS half FROM records),
       runs AS (SELECT 1 AS run, part, sensor_id FROM records, half WHERE page <= half
                UNION ALL SELECT 2, part, sensor_id FROM records
                UNION ALL SELECT 2, part, -sensor_id FROM records WHERE sensor_id % 10 = 7),
       told AS (SELECT run, CASE WHEN sensor_id < 0 THEN 'unknown sensor' WHEN part = 1 THEN 'coverage is not an object'
                                 WHEN part = 5 THEN 'value does not fit decimal(15,6)' ELSE 'loaded' END AS outcome FROM runs
                UNION ALL SELECT 2, 'page is cut or malformed' FROM (SELECT DISTINCT sensor_id FROM records))
       SELECT CAST(run AS BIGINT) AS run, outcome, count(*) AS records,
              CAST(sum(count(*)) OVER (PARTITION BY run) AS BIGINT) AS landed
       FROM told GROUP BY run, outcome""",
)
def _(t: Model) -> DataFrame:
    """Loaded and rejected records of each run, beside those that its pages hold; a cut page counts as one."""
    at = _ingested(t)
    batch = "batch BIGINT"
    bad = t.spark.read.schema(f"sensor_id BIGINT, record STRING, reason STRING, {batch}").json(at["rejected"])
    told = bad.groupBy("batch", F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("records"))
    good = t.spark.read.schema(f"records BIGINT, {batch}").json(at["loaded"])
    told = told.unionByName(good.where("records > 0").withColumn("outcome", F.lit("loaded")))
    pages = files.landed_pages(t.spark, at["landing"], schemas.SENSOR_ENVELOPE, multi_line=False)
    run = F.regexp_extract("file", "/run=([0-9]+)/", 1).cast("bigint")
    held = F.when(F.col("state") == "unreadable", 1).otherwise(F.col("n"))
    landed = pages.groupBy(run.alias("run")).agg(F.sum(held).alias("landed"))
    told = told.select((F.col("batch") + 1).alias("run"), "outcome", "records")
    return landed.join(told, "run", "left").select("run", "outcome", "records", "landed")


@query(
    "daily_avg_stream",
    f"""WITH kept AS (
          SELECT * FROM measurements QUALIFY row_number() OVER (
            PARTITION BY sensor_id, period_from_utc, period_to_utc ORDER BY id % 3 = 2, arrived_at DESC, id DESC) = 1)
        SELECT CAST(period_from_utc AS DATE) AS day, parameter_name, {mean_sql('value', 2)} AS mean_value, count(value) AS n
        FROM kept GROUP BY ALL""",
)
def _(t: Model) -> DataFrame:
    path, table, target, state = (scratch_path(t.spark, n) for n in ("runs", "measurements", "daily", "stream"))
    m = t.measurements()
    third = F.col("id") % 3
    # wrong values, then other rows, then the corrections with rows of all days that come late
    for run in (
        m.where(third == 0).withColumn("value", (F.col("value") - 5).cast(m.schema["value"].dataType)),
        m.where(third == 2),
        m.where(third != 2),
    ):
        run.write.mode("append").parquet(path)
        landed = t.spark.readStream.schema(m.schema).parquet(path)
        ingest.daily_avg_stream(landed, table, target, state, SEQ).awaitTermination()
    return t.spark.read.parquet(target)


# --- page checks --------------------------------------------------------------

register(
    "v_page_completeness",
    lambda t: paging.v_page_completeness(_envelopes(t), ["sensor_id"], paging.PAGE_CAPS["measurements"]),
    """WITH pages AS (SELECT sensor_id, page, count(*) AS n FROM records GROUP BY ALL),
       per_source AS (
         SELECT sensor_id, CAST(sum(n) AS BIGINT) AS landed, count(*) AS pages, max(page) AS last_page,
                arg_max(n, page) AS last_page_size, CAST(1000 AS BIGINT) AS page_limit,
                CASE WHEN sensor_id % 3 <> 0 THEN CAST(sum(n) AS BIGINT) END AS found
         FROM pages GROUP BY sensor_id)
       SELECT *, CASE WHEN found > 0 OR last_page_size < 1000 THEN 'complete' WHEN last_page >= 100 THEN 'truncated: page cap'
                      ELSE 'truncated' END AS status FROM per_source""",
)

@query(
    "v_page_states",
    """WITH sensors AS (SELECT DISTINCT sensor_id FROM records)
       SELECT sensor_id, 'good' AS state, count(DISTINCT page) AS pages, count(*) AS records FROM records GROUP BY sensor_id
       UNION ALL SELECT sensor_id, 'empty', 1 + sensor_id % 2, 0 FROM sensors
       UNION ALL SELECT NULL, 'unreadable', count(*), 0 FROM sensors""",
)
def _(t: Model) -> DataFrame:
    path = landing.land_measurement_pages(t)
    sensors = as_written_table(landing.sensor_list(t).select("sensor_id").distinct(), "sensors")
    # each sensor also has an empty page and a cut one, every second a page without a list
    empty = sensors.select(F.format_string('{"sensor_id":%d,"meta":{"found":"7","page":101,"limit":1000},"results":[]}', "sensor_id"))
    null = sensors.where("sensor_id % 2 = 1").select(
        F.format_string('{"sensor_id":%d,"meta":{"found":"7","page":102,"limit":1000},"results":null}', "sensor_id")
    )
    cut = sensors.select(F.format_string('{"sensor_id":%d,"meta":{"found":"7","page":103,"limit":1000},"results":["{', "sensor_id"))
    empty.union(null).union(cut).write.text(f"{path}/run=9")
    return paging.v_page_states(files.landed_pages(t.spark, path, schemas.SENSOR_ENVELOPE, multi_line=False), ["sensor_id"])


register(
    "v_page_overlap",
    lambda t: paging.v_page_overlap(landing.country_pages(t)),
    """WITH pages AS (SELECT n_name AS code, year(o_orderdate) - 1994 AS page FROM orders
                      JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
       seen AS (SELECT *, min(page) OVER (PARTITION BY code) = page AS fresh FROM pages)
       SELECT CAST(page AS BIGINT) AS page, count(*) AS records, count(*) FILTER (fresh) AS new_records,
              count(*) FILTER (NOT fresh) AS repeated_records FROM seen GROUP BY page""",
)
