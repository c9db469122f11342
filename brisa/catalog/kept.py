"""Queries on what is stored and added to: summaries by day, distinct counts, tables for lookups, large keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.bindings import Model
from brisa.catalog.base import mean_sql, query
from brisa.catalog.loading import KEY, SEQ
from brisa.catalog.reports import NOW, TODAY, _since_sql, since
from brisa.operators import distincts, flatten, loads, summaries
from brisa.catalog.landing import country_pages
from brisa.functions.aggregates import list_parts
from brisa.operators.filters import filter_null
from brisa.plans import compare
from brisa.plans import measurements as meas
from brisa.session import as_written_table, scratch_path
from brisa.sources import lookups, session_catalog
from brisa.streaming import ingest

# --- summaries by day ---------------------------------------------------------


def _corrected_runs(t: Model) -> tuple[DataFrame, ...]:
    """Wrong values, then other rows, then the corrections with rows of all days that come late."""
    m = t.measurements()
    third = F.col("id") % 3
    wrong = (F.col("value") - 5).cast(m.schema["value"].dataType)
    return m.where(third == 0).withColumn("value", wrong), m.where(third == 2), m.where(third != 2)


def _kept_summary(t: Model) -> DataFrame:
    path, table, target, state = (scratch_path(t.spark, n) for n in ("runs", "measurements", "summary", "stream"))
    for run in _corrected_runs(t):
        run.write.mode("append").parquet(path)
        landed = t.spark.readStream.schema(run.schema).parquet(path)
        ingest.daily_summary_stream(landed, table, target, state, SEQ).awaitTermination()
    return summaries.merged(t.spark.read.schema(summaries.SCHEMA).parquet(target))


_KEPT = """kept AS (
          SELECT * FROM measurements QUALIFY row_number() OVER (
            PARTITION BY sensor_id, period_from_utc, period_to_utc ORDER BY id % 3 = 2, arrived_at DESC, id DESC) = 1)"""


@query(
    "daily_avg_kept",
    f"""WITH {_KEPT}
        SELECT CAST(period_from_utc AS DATE) AS day, parameter_name, {mean_sql('value', 2)} AS mean_value, count(value) AS n
        FROM kept GROUP BY ALL""",
)
def _(t: Model) -> DataFrame:
    return summaries.summary_means(_kept_summary(t))


@query(
    "m_pm25_daily_kept",
    f"""WITH {_KEPT}
        SELECT CAST(period_from_utc AS DATE) AS day, count(value) AS n, {mean_sql('value', 2)} AS mean_pm25,
               round(stddev_samp(value), 2) AS sd_value
        FROM kept WHERE parameter_name = 'pm25' AND {_since_sql(7)} GROUP BY ALL HAVING count(value) > 0""",
)
def _(t: Model) -> DataFrame:
    days = _kept_summary(t).where((F.col("parameter_name") == "pm25") & (F.col("day") >= F.lit(since(7))))
    found = summaries.summary_deviations(days)
    return found.select("day", "n", F.col("mean_value").alias("mean_pm25"), "sd_value")


@query(
    "m_spikes_kept",
    f"""WITH stats AS (
          SELECT parameter_name, avg(value) AS mean_x, stddev_samp(value) AS sd_x, {mean_sql('value', 2)} AS mean_all
          FROM measurements GROUP BY parameter_name)
        SELECT sensor_id, m.parameter_name, period_from_utc, CAST(round(value, 2) AS DOUBLE) AS measured, mean_all,
               round(CAST(value AS DOUBLE) - mean_x, 2) AS difference,
               round((CAST(value AS DOUBLE) - mean_x) / sd_x, 2) AS deviations
        FROM measurements m JOIN stats s ON m.parameter_name = s.parameter_name
        WHERE CAST(value AS DOUBLE) > mean_x + 2 * sd_x AND {_since_sql(7)}
        ORDER BY deviations DESC, sensor_id, m.parameter_name, period_from_utc, measured LIMIT 20""",
)
def _(t: Model) -> DataFrame:
    """The statistics of all days from the stored summary; of the measurements only the last seven days are read."""
    summary = as_written_table(summaries.daily_summary(t.measurements()), "summary")
    stats = summaries.summary_statistics(summary)
    return meas.m_spikes(t.measurements(since(7)), NOW, 7, stats=stats)


@query(
    "v_parameter_moments",
    f"""SELECT parameter_name, count(value) AS n, {mean_sql('value', 2)} AS mean_all, round(stddev_samp(value), 4) AS sd_all
        FROM measurements GROUP BY parameter_name""",
)
def _(t: Model) -> DataFrame:
    """Two halves of the days summed up apart and put together."""
    halves = [t.measurements().where(F.dayofmonth("period_from_utc") % 2 == i) for i in (0, 1)]
    parts = [as_written_table(summaries.daily_summary(h), "summary") for h in halves]
    whole = summaries.merged(parts[0].unionByName(parts[1]))
    counts = whole.groupBy("parameter_name").agg(F.sum("n").alias("n"))
    found = summaries.summary_statistics(whole).join(counts, "parameter_name")
    return found.select("parameter_name", "n", F.round("mean_all", 2).alias("mean_all"), F.round("sd_all", 4).alias("sd_all"))


# --- distinct counts ----------------------------------------------------------


@query(
    "s_overview_bitmaps",
    """SELECT count(*) AS rows, count(DISTINCT id) AS stations, count(DISTINCT sensor_id) AS sensors,
              count(DISTINCT provider_id) AS providers, count(DISTINCT locality) AS localities,
              min(extracted_at) AS first_load, max(extracted_at) AS last_load FROM station""",
)
def _(t: Model) -> DataFrame:
    """Ids of stations and sensors are counted before any join; providers and localities from the ids that occur."""
    rows = t.station("id", "sensor_id", "extracted_at")
    per_pair = as_written_table(
        rows.groupBy("id", "sensor_id").agg(
            F.count(F.lit(1)).alias("rows"), F.min("extracted_at").alias("first"), F.max("extracted_at").alias("last")
        ),
        "pairs",
    )
    parts = t.table("part").select(F.col("p_partkey").alias("sensor_id"), F.col("p_size").alias("provider"))
    places = t.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("country_id"))
    places = places.join(t._nation("country_id"), "country_id", "left").select("id", "locality")
    number = distincts.numbered(places, "locality", "number")
    places = places.join(number, "locality", "left").select("id", "number")
    seen = per_pair.join(parts, "sensor_id", "left").join(places, "id", "left")
    ids = {"stations": "id", "sensors": "sensor_id", "providers": "provider", "localities": "number"}
    counts = distincts.bitmap_counts(distincts.distinct_bitmaps(seen, ids), list(ids))
    of_all = per_pair.agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first_load"), F.max("last").alias("last_load")
    )
    whole = of_all.select(F.struct("*")).scalar()
    return counts.select("*", whole["rows"].alias("rows"), whole["first_load"].alias("first_load"), whole["last_load"].alias("last_load"))


@query(
    "s_by_provider_bitmaps",
    """SELECT provider_name, provider_id, count(DISTINCT id) AS stations, count(DISTINCT sensor_name) AS sensor_names
       FROM station WHERE provider_name IS NOT NULL GROUP BY ALL""",
)
def _(t: Model) -> DataFrame:
    """Two distinct counts per group in one pass; names are numbered by a dictionary of the dimension."""
    parts = t.table("part").select(
        F.col("p_partkey").alias("sensor_id"), F.col("p_size").alias("provider_id"),
        F.col("p_brand").alias("provider_name"), F.col("p_type").alias("sensor_name"),
    )
    number = distincts.numbered(parts, "sensor_name", "number")
    parts = filter_null(parts, not_null=["provider_name"]).join(number, "sensor_name", "left").drop("sensor_name")
    rows = t.station("id", "sensor_id").join(parts, "sensor_id")
    ids, groups = {"stations": "id", "sensor_names": "number"}, ["provider_name", "provider_id"]
    return distincts.bitmap_counts(distincts.distinct_bitmaps(rows, ids, groups), list(ids), groups)


_ACTIVE = f"""SELECT parameter_name, count(DISTINCT sensor_id) AS sensors
       FROM measurements WHERE {_since_sql(7)} GROUP BY parameter_name"""


@query("m_active_sensors_kept", _ACTIVE)
def _(t: Model) -> DataFrame:
    """Bitmaps per day and parameter; the newest three days are added to the stored ones, seven days are put together."""
    groups, path = ["parameter_name", "day"], scratch_path(t.spark, "bitmaps")
    m = t.measurements().withColumn("day", F.to_date("period_from_utc"))
    for run in (m.where(F.col("day") < F.lit(since(3))), m.where(F.col("day") >= F.lit(since(3)))):
        maps = distincts.distinct_bitmaps(run, {"sensors": "sensor_id"}, groups)
        maps.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)
    recent = t.spark.read.parquet(path).where(F.col("day") >= F.lit(since(7)))
    return distincts.bitmap_counts(distincts.merged_bitmaps(recent, ["parameter_name"]), ["sensors"], ["parameter_name"])


@query(
    "m_active_sensors_approx",
    f"""SELECT parameter_name, span, count(DISTINCT sensor_id) AS sensors, true AS within_bound
        FROM measurements, (VALUES (1), (7), (40)) s(span)
        WHERE period_from_utc >= TIMESTAMP '{TODAY} 00:00:00' - INTERVAL 1 DAY * span GROUP BY ALL""",
)
def _(t: Model) -> DataFrame:
    """Sketches per day and parameter answer several spans of days; beside them the exact counts, and whether the error is within the bound."""
    m = t.measurements().withColumn("day", F.to_date("period_from_utc"))
    stored = as_written_table(distincts.daily_sketches(m, "sensor_id", ["parameter_name", "day"]), "sketches")
    spans = [(span, since(span)) for span in (1, 7, 40)]
    ranges = F.array(*[F.struct(F.lit(s).alias("span"), F.lit(d).alias("first")) for s, d in spans])

    def spanned(df: DataFrame) -> DataFrame:
        return df.select("*", F.inline(ranges)).where("day >= first")

    near = distincts.sketch_counts(spanned(stored), "near", ["parameter_name", "span"])
    exact = spanned(m).groupBy("parameter_name", "span").agg(F.count_distinct("sensor_id").alias("sensors"))
    off = F.abs(F.col("near") - F.col("sensors")) <= distincts.SKETCH_BOUND * F.col("sensors")
    return exact.join(near, ["parameter_name", "span"]).select("parameter_name", "span", "sensors", off.alias("within_bound"))


# --- lookups and large keyed tables -------------------------------------------

_WANTED = 4321


@query(
    "lookup_by_id",
    f"""SELECT id, sensor_id, parameter_name, CAST(value AS DOUBLE) AS value, period_from_utc FROM measurements
        WHERE id = {_WANTED} % (SELECT count(*) FROM events)""",
)
def _(t: Model) -> DataFrame:
    """One measurement by its id, in a table whose files are clustered by time."""
    m = t.measurements().select("id", "sensor_id", "parameter_name", "value", "period_from_utc")
    path = scratch_path(t.spark, "lookups")
    lookups.write_for_lookups(m, path, ["period_from_utc", "id"], ["id"])
    wanted = _WANTED % t.table("events").count()
    return lookups.look_up(t.spark, path, m.schema, "id", wanted)


@query(
    "upsert_hashed",
    """SELECT sensor_id, period_from_utc, period_to_utc, arg_max(parameter_name, (arrived_at, id)) AS parameter_name,
              CAST(arg_max(value, (arrived_at, id)) AS DOUBLE) AS value, arg_max(id, (arrived_at, id)) AS id
       FROM measurements GROUP BY ALL""",
)
def _(t: Model) -> DataFrame:
    target = scratch_path(t.spark, "hashed")
    m = t.measurements().select(*KEY, "parameter_name", "value", "id", "arrived_at", F.col("id").alias("place"))
    noon = F.col("arrived_at") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    for run in (m.where(noon), m.where(~noon)):
        result = loads.upsert_hashed(target, run, KEY, ["arrived_at", "place"], buckets=16)
    return result


# --- codes seen, lists in parts, ranges, copies -------------------------------


@query(
    "new_codes_by_run",
    """WITH pages AS (SELECT n_name AS code, year(o_orderdate) - 1994 AS page FROM orders
                      JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
       landed AS (SELECT code, 1 AS run FROM pages WHERE page % 2 = 0 AND code < 'NATION_2'
                  UNION ALL SELECT code, 2 FROM pages WHERE page % 2 = 1)
       SELECT CAST(min(run) AS BIGINT) AS run, code FROM landed GROUP BY code""",
)
def _(t: Model) -> DataFrame:
    """The second run lands codes of the first again; the state in the checkpoint knows them."""
    path, target, state = (scratch_path(t.spark, n) for n in ("pages", "codes", "stream"))
    pages = country_pages(t)
    for run in (pages.where("page % 2 = 0 AND code < 'NATION_2'"), pages.where("page % 2 = 1")):
        run.write.mode("append").parquet(path)
        landed = t.spark.readStream.schema(pages.schema).parquet(path)
        ingest.new_codes_stream(landed, "code", target, state).awaitTermination()
    found = t.spark.read.schema("code STRING, batch BIGINT").parquet(target)
    return found.select((F.col("batch") + 1).alias("run"), "code")


_PART = 200


@query(
    "agg_string_agg_parts",
    f"""WITH places AS (
          SELECT id, sensor_name, coalesce(sum(length(sensor_name) + 2) OVER (
                   PARTITION BY id ORDER BY sensor_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
          FROM station WHERE sensor_name IS NOT NULL)
        SELECT id, CAST(begins // {_PART} AS BIGINT) AS part, string_agg(sensor_name, ', ' ORDER BY sensor_name) AS sensor_names
        FROM places GROUP BY ALL""",
)
def _(t: Model) -> DataFrame:
    return list_parts(t.station("id", "sensor_name"), ["id"], "sensor_name", "sensor_names", _PART)


@query(
    "v_availability_of_ranges",
    f"""WITH r AS (
          SELECT i AS ordinal, 'range ' || i AS range, first_day, first_day + CAST(i % 11 AS INTEGER) * 9 AS last_day
          FROM (SELECT i, DATE '{TODAY}' + 300 - CAST(i * 7 % 400 AS INTEGER) AS first_day FROM range(1000) x(i))),
        counted AS (
          SELECT ordinal, range, first_day, last_day, count(sensor_id) AS n
          FROM r LEFT JOIN measurements ON CAST(period_from_utc AS DATE) BETWEEN first_day AND last_day GROUP BY ALL)
        SELECT *, ordinal = (SELECT min(ordinal) FROM counted WHERE n > 0) AS is_answer FROM counted""",
)
def _(t: Model) -> DataFrame:
    """A thousand overlapping ranges, some before and after all days."""
    first = F.date_sub(F.date_add(F.lit(TODAY), 300), (F.col("id") * 7 % 400).cast("int"))
    ranges = t.spark.range(1000).select(
        F.col("id").alias("ordinal"), F.concat(F.lit("range "), "id").alias("range"), first.alias("first_day"),
        F.date_add(first, (F.col("id") % 11 * 9).cast("int")).alias("last_day"),
    )
    return compare.availability_of_ranges(t.measurements(), ranges)


@query(
    "v_migration_by_content",
    """SELECT id, CASE id % 997 WHEN 1 THEN 'missing' WHEN 2 THEN 'changed' END AS difference
       FROM measurements WHERE id % 997 IN (1, 2)
       UNION ALL SELECT -1 - id, 'extra' FROM measurements WHERE id % 997 = 3""",
)
def _(t: Model) -> DataFrame:
    """A copy that lacks some rows, holds some with another unit or none, and has some of its own."""
    m = t.measurements()
    place = F.col("id") % 997
    unit = F.when(F.col("id") % 2 == 0, F.lit("ppm"))
    copy = m.where(place != 1).withColumn("parameter_units", F.when(place == 2, unit).otherwise(F.col("parameter_units")))
    own = m.where(place == 3).withColumn("id", -1 - F.col("id"))
    copy = as_written_table(copy.unionByName(own), "copy")
    return compare.table_difference(m, copy, ["id"])


# --- tables of the session catalog --------------------------------------------


@query(
    "catalog_tables",
    """WITH counted AS (
         SELECT 'countries' AS table_name, count(*) AS rows FROM countries
         UNION ALL SELECT 'locations', count(*) FROM locations
         UNION ALL SELECT 'parameters', count(*) FROM parameters
         UNION ALL SELECT 'measurements', count(*) FROM measurements
         UNION ALL SELECT 'station', count(*) FROM station
         UNION ALL SELECT 'api_posts', count(*) FROM posts
         UNION ALL SELECT 'dag_runs', count(DISTINCT CAST(period_from_utc AS DATE)) FROM measurements)
       SELECT table_name, rows, least(rows, 2) AS samples FROM counted""",
)
def _(t: Model) -> DataFrame:
    """All tables created, filled, one loaded again, and listed with two sample rows each."""
    location = scratch_path(t.spark, "database")
    database = f"brisa_{location[-8:]}"
    created = session_catalog.create_tables(t.spark, database, location)
    m = t.measurements().withColumn("period_date", F.to_date("period_from_utc"))
    content = {
        "countries": t.countries(),
        "locations": t.locations(),
        "parameters": t.parameters(),
        "measurements": m,
        "station": t.station("id", "name", "sensor_id", "latitude", "longitude"),
        "api_posts": flatten.flatten_posts(t.raw_posts()),
        "dag_runs": m.select(F.col("period_date").alias("dt"), F.lit("daily").alias("dag_id")).distinct(),
    }
    if sorted(created) != sorted(content) or session_catalog.create_tables(t.spark, database, location):
        raise AssertionError("tables were left out or created twice")
    for name, df in [*content.items(), ("measurements", m.where(F.col("period_date") >= F.lit(since(7))))]:
        session_catalog.load_table(t.spark, database, name, df)
    return session_catalog.catalog_inventory(t.spark, database).withColumn("samples", F.size("samples").cast("bigint"))
