"""Whole tables through the sinks, faulty tables through the checks, and orders by position."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa import schemas
from brisa.bindings import Model
from brisa.catalog import landing
from brisa.catalog.base import query, ratio_sql, register
from brisa.catalog.loading import KEY, SEQ, _half_hours
from brisa.catalog.reports import C_NOW, _region_sql
from brisa.functions import aggregates as agg
from brisa.functions import labels
from brisa.operators import flatten, loads, ordering
from brisa.plans import countries as ctry
from brisa.plans import paging, quality, stations
from brisa.session import scratch_path
from brisa.sources import files

# --- sinks, all columns ---------------------------------------------------------

_LOCATIONS = """SELECT location_id, name, locality, timezone, country_code, country_name, is_mobile, is_monitor,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, sensors FROM locations"""


@query("sink_csv_whole", _LOCATIONS)
def _(t: Model) -> DataFrame:
    """All columns of the locations; their sensor lists hold quotes and commas."""
    path, rows = scratch_path(t.spark, "locations-csv"), t.locations()
    files.write_csv(rows, path)
    return files.read_csv(t.spark, path, rows.schema)


@query("sink_json_whole", _LOCATIONS)
def _(t: Model) -> DataFrame:
    path, rows = scratch_path(t.spark, "locations-json"), t.locations()
    files.write_json(rows, path)
    return files.read_json_list(t.spark, path, rows.schema, multi_line=False)


@query("sink_slice_days_whole", "SELECT *, strftime(ts, '%Y%m%d') AS dt FROM events")
def _(t: Model) -> DataFrame:
    """All events as one folder of CSV a day, read back with every value."""
    base, events = scratch_path(t.spark, "event-days"), t.table("events")
    files.export_days(events, "ts", date(2000, 1, 1), date(2100, 1, 1), base)
    return files.read_csv(t.spark, base, T.StructType([*events.schema.fields, T.StructField("dt", T.StringType())]))


# --- loads and pages ------------------------------------------------------------

_HOLES = "CASE WHEN has_flags THEN NULL ELSE period_to_utc END"


@query(
    "null_key_loads",
    f"""WITH holes AS (SELECT sensor_id, period_from_utc, {_HOLES} AS period_to_utc, value, arrived_at, id FROM measurements),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY sensor_id, period_from_utc, period_to_utc
                                                  ORDER BY arrived_at DESC, id DESC) AS rn FROM holes)
        SELECT sensor_id, period_from_utc, period_to_utc, CAST(value AS DOUBLE) AS value
        FROM numbered WHERE rn = 1 OR period_to_utc IS NULL""",
)
def _(t: Model) -> DataFrame:
    """Two loads: rows with a null in the key meet stored ones of the same values, and all stay."""
    target = scratch_path(t.spark, "holes")
    for half in _half_hours(t):
        holes = F.when(~F.col("has_flags"), F.col("period_to_utc"))
        rows = half.select(*KEY, "value", "has_flags", *SEQ).withColumn("period_to_utc", holes).drop("has_flags")
        result = loads.upsert(target, rows, KEY, SEQ)
    return result


_FOUND = "CASE WHEN sensor_id % 8 = 0 THEN n + 5 WHEN sensor_id % 8 = 1 THEN n + 9 ELSE n END"


@query(
    "v_source_completeness",
    f"""WITH pages AS (SELECT sensor_id, page, count(*) AS n FROM records GROUP BY ALL),
       per_source AS (SELECT sensor_id, CAST(sum(n) AS BIGINT) AS n, count(*) AS pages, max(page) AS last FROM pages GROUP BY sensor_id)
       SELECT sensor_id, CASE WHEN sensor_id % 8 IN (2, 3, 4) THEN 0 ELSE n END AS landed,
              CASE WHEN sensor_id % 8 IN (2, 3, 4) THEN 0 ELSE pages END AS good_pages,
              CASE WHEN sensor_id % 8 = 2 THEN NULL WHEN sensor_id % 8 = 1 THEN last + 100 ELSE last END AS last_page,
              CASE WHEN sensor_id % 8 IN (2, 5) THEN NULL WHEN sensor_id % 8 = 3 THEN 0 ELSE {_FOUND} END AS found,
              CASE sensor_id % 8 WHEN 0 THEN 'truncated' WHEN 1 THEN 'truncated: page cap' WHEN 2 THEN 'no page'
                                 WHEN 4 THEN 'no records' ELSE 'complete' END AS status
       FROM per_source""",
)
def _(t: Model) -> DataFrame:
    """Sources that tell more records than landed, at the page cap and below it, with cut, empty and truly no records."""
    path = scratch_path(t.spark, "landing")
    kind = F.col("sensor_id") % 8
    page = F.floor(F.col("event_id") / landing.PAGE_SIZE) + 1
    per_page = t.measurement_records.groupBy("sensor_id", page.alias("page")).agg(F.count(F.lit(1)).alias("held"))
    totals = per_page.groupBy("sensor_id").agg(F.sum("held").alias("n"))
    found = F.expr(_FOUND).cast("string")
    told = F.when(kind == 5, F.lit(">1000")).when(kind == 3, F.lit("0")).otherwise(found)
    results = F.when(kind.isin(3, 4), F.lit("")).otherwise(F.expr("array_join(array_repeat('{}', CAST(held AS INT)), ',')"))
    number = F.when(kind == 1, F.col("page") + 100).otherwise(F.col("page"))
    text = F.format_string(
        '{"sensor_id":%d,"meta":{"found":"%s","page":%d,"limit":%d},"results":[%s]}',
        "sensor_id", told, number, F.lit(landing.PAGE_SIZE), results,
    )
    cut = F.when(kind == 2, F.expr("substr(text, 1, length(text) - 2)")).otherwise(F.col("text"))
    lines = per_page.join(totals, "sensor_id").withColumn("text", text).select(cut.alias("value"))
    # the same pages land twice
    for run in (1, 2):
        lines.write.text(f"{path}/run={run}")
    pages = files.landed_pages(t.spark, path, schemas.SENSOR_ENVELOPE, multi_line=False)
    return paging.v_source_completeness(pages, totals, "sensor_id", paging.PAGE_CAPS["measurements"])


@query(
    "iso_codes_to_ask",
    "SELECT 'table' AS read, code FROM (SELECT DISTINCT code FROM countries) UNION ALL SELECT 'unreadable', unnest(['CL', 'AR', 'BR', 'CO', 'PE'])",
)
def _(t: Model) -> DataFrame:
    """Codes of a table that can be read, and the short list for one whose files are no Parquet."""
    broken = scratch_path(t.spark, "broken")
    t.table("nation").select("n_name").write.text(broken)
    found = quality.iso_codes_to_ask(t.spark, t.countries).select(F.lit("table").alias("read"), "code")
    short = quality.iso_codes_to_ask(t.spark, lambda: t.spark.read.schema("code STRING").parquet(broken))
    return found.unionAll(short.select(F.lit("unreadable").alias("read"), "code"))


# --- countries as landed, with the number of their locations --------------------


def _landed_countries(t: Model) -> DataFrame:
    """The payload tells no locations and no sources; the first are counted."""
    flat = flatten.flatten_countries(landing.country_records(t))
    aligned = loads.align_schema(flat, schemas.COUNTRIES, schemas.TABLES["countries"].defaults)
    return ctry.with_location_counts(aligned, t.locations())


_LANDED = """landed AS (
         SELECT c.code, c.name, c."datetimeFirst", c."datetimeLast", CAST(count(l.location_id) AS INTEGER) AS locations
         FROM countries c LEFT JOIN locations l ON l.country_code = c.code GROUP BY ALL)"""


@query(
    "c_top_locations_landed",
    f"""WITH {_LANDED}
        SELECT code, name, locations, "datetimeFirst", "datetimeLast" FROM landed
        WHERE locations > 0 ORDER BY locations DESC, code LIMIT 10""",
)
def _(t: Model) -> DataFrame:
    return ctry.c_top_locations(_landed_countries(t)).drop("sources", "parameter_count")


@query(
    "c_stale_landed",
    f"""WITH {_LANDED}
        SELECT code, name, locations, "datetimeLast",
               CAST(epoch(TIMESTAMP '{C_NOW}') - epoch("datetimeLast") AS BIGINT) // 86400 AS days_inactive
        FROM landed WHERE "datetimeLast" < TIMESTAMP '{C_NOW}' - INTERVAL 2 DAY AND locations > 0""",
)
def _(t: Model) -> DataFrame:
    return ctry.c_stale(_landed_countries(t), C_NOW, days=2)


# --- checks on tables with faults -----------------------------------------------


def _faulty_countries(t: Model) -> DataFrame:
    """Every fourth country twice, every fifth without code, every seventh without name, first hours of all kinds."""
    c, key = t.countries(), F.col("country_id")
    hour = F.lpad((key % 24).cast("string"), 2, "0")
    c = c.withColumns({
        "code": F.when(key % 5 != 0, F.col("code")),
        "name": F.when(key % 7 != 0, F.col("name")),
        "datetimeFirst_raw": F.concat(F.substring("datetimeFirst_raw", 1, 11), hour, F.lit(":00:00Z")),
    })
    return c.unionAll(c.where(key % 4 == 0))


_FAULTY = """once AS (
         SELECT country_id, CASE WHEN country_id % 5 <> 0 THEN code END AS code, CASE WHEN country_id % 7 <> 0 THEN name END AS name,
                substr("datetimeFirst_raw", 1, 11) || lpad(CAST(country_id % 24 AS VARCHAR), 2, '0') || ':00:00Z' AS raw,
                locations, sources FROM countries),
       faulty AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE country_id % 4 = 0)"""

register(
    "c_integrity_faults",
    lambda t: ctry.c_integrity(_faulty_countries(t)),
    f"""WITH {_FAULTY}
        SELECT '{ctry.DUPLICATED_CODES}' AS problem, count(*) AS found
          FROM (SELECT code FROM faulty WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1)
        UNION ALL SELECT '{ctry.DUPLICATED_IDS}', count(*)
          FROM (SELECT country_id FROM faulty WHERE country_id IS NOT NULL GROUP BY country_id HAVING count(*) > 1)
        UNION ALL SELECT '{ctry.WITHOUT_CODE}', count(*) FROM faulty WHERE code IS NULL
        UNION ALL SELECT '{ctry.WITHOUT_NAME}', count(*) FROM faulty WHERE name IS NULL""",
)
register(
    "lc_dup_codes_faults",
    lambda t: ctry.lc_dup_codes(_faulty_countries(t)),
    f"WITH {_FAULTY} SELECT code, count(*) AS duplicates FROM faulty GROUP BY code HAVING count(*) > 1",
)
register(
    "v_country_dups_faults",
    lambda t: quality.v_country_dups(_faulty_countries(t)),
    f"WITH {_FAULTY} SELECT code, count(*) AS n FROM faulty GROUP BY code HAVING count(*) > 1",
)
register(
    "c_by_region_hours",
    lambda t: ctry.c_by_region(_faulty_countries(t)),
    f"""WITH {_FAULTY}
        SELECT {_region_sql('raw')} AS region, count(*) AS countries, CAST(sum(locations) AS BIGINT) AS locations,
               CAST(sum(sources) AS BIGINT) AS sources FROM faulty GROUP BY ALL""",
)


@query(
    "s_integrity_faults",
    f"""WITH faulty AS (
          SELECT CASE WHEN id % 9 <> 0 THEN id END AS id, CASE WHEN sensor_id % 8 <> 0 THEN sensor_id END AS sensor_id,
                 CASE WHEN id % 7 <> 0 THEN name END AS name, CASE WHEN id % 6 <> 0 THEN latitude END AS latitude,
                 CASE WHEN sensor_id % 5 <> 0 THEN longitude END AS longitude,
                 CASE WHEN sensor_id % 4 <> 0 THEN provider_name END AS provider_name FROM station)
        SELECT '{stations.WITHOUT_STATION_ID}' AS problem, count(*) AS found FROM faulty WHERE id IS NULL
        UNION ALL SELECT '{stations.WITHOUT_SENSOR_ID}', count(*) FROM faulty WHERE sensor_id IS NULL
        UNION ALL SELECT '{stations.WITHOUT_STATION_NAME}', count(*) FROM faulty WHERE name IS NULL
        UNION ALL SELECT '{stations.WITHOUT_COORDINATES}', count(*) FROM faulty WHERE latitude IS NULL OR longitude IS NULL
        UNION ALL SELECT '{stations.WITHOUT_PROVIDER}', count(*) FROM faulty WHERE provider_name IS NULL""",
)
def _(t: Model) -> DataFrame:
    by = {"id": ("id", 9), "sensor_id": ("sensor_id", 8), "name": ("id", 7), "latitude": ("id", 6),
          "longitude": ("sensor_id", 5), "provider_name": ("sensor_id", 4)}
    st = t.station(*by, combined=True)
    holes = [F.when(F.col(key) % n != 0, F.col(c)).alias(c) for c, (key, n) in by.items()]
    return stations.s_integrity(st.select(*holes, agg.ROWS))


@query(
    "v_quality_faults",
    f"""WITH faulty AS (
          SELECT CASE WHEN id % 7 <> 0 THEN value END AS value, CASE WHEN id % 11 <> 0 THEN period_from_utc END AS period_from_utc,
                 has_flags FROM measurements),
        counted AS (SELECT count(*) AS total, count(*) - count(value) AS null_values, count(*) - count(period_from_utc) AS null_dates,
                           count(*) FILTER (has_flags) AS flagged FROM faulty)
        SELECT *, {ratio_sql('(null_values * 100)', 'total', 1)} AS null_values_percent,
               {ratio_sql('(null_dates * 100)', 'total', 1)} AS null_dates_percent,
               {ratio_sql('(flagged * 100)', 'total', 1)} AS flagged_percent FROM counted""",
)
def _(t: Model) -> DataFrame:
    m = t.measurements()
    holes = {"value": F.when(F.col("id") % 7 != 0, F.col("value")),
             "period_from_utc": F.when(F.col("id") % 11 != 0, F.col("period_from_utc"))}
    return quality.v_quality(m.withColumns(holes))


@query(
    "v_geo_cover_faults",
    """WITH faulty AS (
         SELECT CASE WHEN location_id % 5 <> 0 THEN latitude END AS latitude,
                CASE WHEN location_id % 7 <> 0 THEN longitude END AS longitude FROM locations)
       SELECT count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS with_coordinates,
              count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS without_coordinates, count(*) AS total,
              CAST(min(latitude) AS DOUBLE) AS min_latitude, CAST(max(latitude) AS DOUBLE) AS max_latitude,
              CAST(min(longitude) AS DOUBLE) AS min_longitude, CAST(max(longitude) AS DOUBLE) AS max_longitude FROM faulty""",
)
def _(t: Model) -> DataFrame:
    holes = {"latitude": F.when(F.col("location_id") % 5 != 0, F.col("latitude")),
             "longitude": F.when(F.col("location_id") % 7 != 0, F.col("longitude"))}
    return quality.v_geo_cover(t.locations().withColumns(holes))


# --- orders by position ---------------------------------------------------------

register(
    "sort_multi_position",
    lambda t: ordering.with_position(
        t.table("lineitem").select(
            F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("station"),
            F.col("l_shipdate").alias("extracted_at")),
        "station", "-extracted_at", "id", "line",
    ),
    """SELECT l_orderkey AS id, l_linenumber AS line, l_suppkey AS station, l_shipdate AS extracted_at,
              row_number() OVER (ORDER BY l_suppkey, l_shipdate DESC, l_orderkey, l_linenumber) AS position FROM lineitem""",
)
register(
    "sort_case_position",
    lambda t: ordering.with_position(
        t.measurements().groupBy("parameter_name").agg(agg.agg_count().alias("n")),
        labels.parameter_rank(F.col("parameter_name")), "parameter_name",
    ),
    """WITH counted AS (SELECT parameter_name, count(*) AS n FROM measurements GROUP BY parameter_name)
       SELECT *, row_number() OVER (ORDER BY coalesce(list_position(['pm25', 'pm10', 'no2', 'co', 'o3', 'so2'], parameter_name), 7),
                                             parameter_name) AS position FROM counted""",
)
register(
    "sort_expr_position",
    lambda t: ordering.with_position(
        t.location_spans().select("location_id", "datetime_first", "datetime_last"),
        (F.col("datetime_last") - F.col("datetime_first")).desc_nulls_first(), "location_id",
    ),
    """SELECT location_id, datetime_first, datetime_last,
              row_number() OVER (ORDER BY datetime_last - datetime_first DESC NULLS FIRST, location_id) AS position FROM locations""",
)
