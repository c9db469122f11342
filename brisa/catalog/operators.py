"""Filters, joins, aggregates, ordering and metric rows, one query per operator."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from brisa.bindings import COUNTRIES_AS_OF, MEASUREMENTS_AS_OF
from brisa.catalog.base import mean_sql, register
from brisa.catalog.landing import country_pages
from brisa.catalog.reports import since
from brisa.functions import aggregates as agg
from brisa.functions import labels
from brisa.functions.scalars import concat_key, date_of, hour_of
from brisa.operators import filters, joins, metrics, ordering
from brisa.plans import measurements as meas

NOW, C_NOW = MEASUREMENTS_AS_OF, COUNTRIES_AS_OF
_VALUE = "CAST(value AS DOUBLE) AS value"

# --- projections and filters ----------------------------------------------------

register(
    "project",
    lambda t: filters.project(
        t.station("id", "name", "locality", "provider_name"),
        {"name": "estacion", "locality": "localidad", "provider_name": "proveedor", "id": "station_id"},
    ),
    "SELECT name AS estacion, locality AS localidad, provider_name AS proveedor, id AS station_id FROM station",
)
register(
    "filter_eq",
    lambda t: filters.filter_eq(t.measurements(parameters=("o3",)), "parameter_name", "o3").select("id", "value"),
    f"SELECT id, {_VALUE} FROM measurements WHERE parameter_name = 'o3'",
)
register(
    "filter_in",
    lambda t: filters.filter_in(t.station("id", "sensor_id", "locality"), "locality", ["NATION_5", "NATION_9"]),
    "SELECT id, sensor_id, locality FROM station WHERE locality IN ('NATION_5', 'NATION_9')",
)
register(
    "filter_like_ci",
    lambda t: filters.filter_like_ci(t.station("id", "sensor_id", "sensor_name"), "sensor_name", "%Eco%"),
    "SELECT id, sensor_id, sensor_name FROM station WHERE sensor_name ILIKE '%Eco%'",
)
register(
    "filter_like_lower",
    lambda t: filters.filter_like_lower(
        t.locations().select("location_id", "name", "locality"), ["locality", "name"], "%mach%"
    ),
    """SELECT location_id, name, locality FROM locations
       WHERE lower(locality) LIKE '%mach%' OR lower(name) LIKE '%mach%'""",
)
register(
    "filter_json_text",
    lambda t: filters.filter_json_text(t.locations().select("location_id", "sensors"), "sensors", ["pm25", "no2"]),
    "SELECT location_id, sensors FROM locations WHERE sensors LIKE '%pm25%' OR sensors LIKE '%no2%'",
)
register(
    "filter_json_exact",
    lambda t: filters.filter_json_text(
        t.countries().select("code", "parameters"), "parameters", ["pm25", "pm10"], "all", exact=True
    ),
    "SELECT code, parameters FROM countries WHERE parameters = '[\"pm25\",\"pm10\",\"o3\"]'",
)
register(
    "filter_null",
    lambda t: filters.filter_null(
        t.measurements().select(
            "id", "value", F.when(~F.col("has_flags"), F.col("period_to_utc")).alias("period_to_utc")
        ),
        null=["period_to_utc"], not_null=["value"],
    ),
    f"SELECT id, {_VALUE}, CAST(NULL AS TIMESTAMP) AS period_to_utc FROM measurements WHERE has_flags",
)
register(
    "filter_cmp",
    lambda t: filters.filter_cmp(t.countries().select("code", "locations", "sources"), locations=0, sources=4),
    "SELECT code, locations, sources FROM countries WHERE locations > 0 AND sources > 4",
)
register(
    "filter_recent",
    lambda t: filters.filter_recent(t.measurements(since(3)), "period_from_utc", NOW, 3).select("id", "period_from_utc"),
    f"SELECT id, period_from_utc FROM measurements WHERE period_from_utc >= TIMESTAMP '{NOW}' - INTERVAL 3 DAY",
)
register(
    "filter_stale",
    lambda t: filters.filter_stale(
        t.location_spans().select("location_id", "datetime_last"), "datetime_last", C_NOW, 30
    ),
    f"SELECT location_id, datetime_last FROM locations WHERE datetime_last < TIMESTAMP '{C_NOW}' - INTERVAL 30 DAY",
)
register(
    "filter_last_24h",
    lambda t: filters.filter_last_24h(t.table("events").select("event_id", "ts"), "ts", "2024-01-20 13:30:00"),
    "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 13:30:00' - INTERVAL 1 DAY",
)
register(
    "filter_today",
    lambda t: filters.filter_today(t.table("events").select("event_id", "ts"), "ts", "2024-01-20 13:30:00"),
    "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'",
)
register(
    "filter_halfopen",
    lambda t: filters.filter_halfopen(
        t.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", date(1998, 3, 1), date(1998, 4, 1)
    ),
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= DATE '1998-03-01' AND o_orderdate < DATE '1998-04-01'""",
)
register(
    "filter_window_param",
    lambda t: filters.filter_window(
        t.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", date(1998, 3, 1), date(1998, 4, 1)
    ),
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN DATE '1998-03-01' AND DATE '1998-04-01'",
)
register(
    "case_label",
    lambda t: t.station("sensor_name").groupBy("sensor_name").agg(agg.agg_count().alias("n")).withColumn(
        "label",
        labels.case_label(
            [
                (F.col("sensor_name").startswith("E"), F.when(F.col("n") > 10, "many e").otherwise("few e")),
                (F.col("sensor_name").contains("O"), "has o"),
            ],
            "other",
        ),
    ),
    """SELECT sensor_name, count(*) AS n,
              CASE WHEN sensor_name LIKE 'E%' THEN CASE WHEN count(*) > 10 THEN 'many e' ELSE 'few e' END
                   WHEN sensor_name LIKE '%O%' THEN 'has o' ELSE 'other' END AS label
       FROM station GROUP BY sensor_name""",
)
register(
    "bool_label",
    lambda t: t.locations().select(
        "location_id",
        labels.bool_label(F.col("is_mobile"), labels.MOBILE_LABELS).alias("mobile"),
        labels.bool_label(F.col("is_monitor"), labels.MONITOR_LABELS).alias("monitor"),
    ),
    """SELECT location_id, CASE WHEN is_mobile THEN 'Móvil' ELSE 'Fijo' END AS mobile,
              CASE WHEN is_monitor THEN 'Monitor' ELSE 'No Monitor' END AS monitor FROM locations""",
)

# --- joins ------------------------------------------------------------------------

register(
    "join_inner_country",
    lambda t: joins.join_inner_country(t.countries(), t.station("id", "sensor_id", "country_id")).select(
        "id", "sensor_id", "country_code"
    ),
    "SELECT s.id, s.sensor_id, c.code AS country_code FROM station s JOIN countries c ON s.country_id = c.country_id",
)
register(
    "join_inner_location",
    lambda t: joins.join_inner_location(t.measurements(), t.locations()).select("id", "location_name"),
    "SELECT m.id, l.name AS location_name FROM measurements m JOIN locations l ON m.location_id = l.location_id",
)
register(
    "join_left_agg",
    lambda t: joins.join_left_agg(
        t.countries(), t.locations(), "code", "country_code", ["name", "code"], "location_id", "n", "ids"
    ),
    """SELECT c.name, c.code, count(l.location_id) AS n, count(DISTINCT l.location_id) AS ids
       FROM countries c LEFT JOIN locations l ON l.country_code = c.code
       GROUP BY c.name, c.code HAVING count(l.location_id) > 0""",
)
register(
    "join_stats_theta",
    lambda t: joins.join_stats_theta(
        t.measurements().select("id", "parameter_name", "value"),
        meas.parameter_statistics(t.measurements()),
        "parameter_name",
        F.col("value").cast("double") > F.col("mean_all").cast("double") + 2 * F.col("sd_all"),
    ).select("id", "parameter_name", "value"),
    f"""WITH s AS (SELECT parameter_name, avg(value) AS a, stddev_samp(value) AS d FROM measurements GROUP BY ALL)
        SELECT m.id, m.parameter_name, {_VALUE} FROM measurements m JOIN s ON m.parameter_name = s.parameter_name
        WHERE CAST(value AS DOUBLE) > a + 2 * d""",
)
register(
    "lateral_explode",
    lambda t: joins.lateral_explode(t.countries(), "parameters", "parameter").select("code", "parameter"),
    "SELECT code, unnest(from_json(parameters, '[\"VARCHAR\"]')) AS parameter FROM countries",
)
register(
    "scalar_subquery",
    lambda t: joins.scalar_subquery(
        t.station("id", "sensor_id", "country_id"),
        "country_id", filters.filter_eq(t.countries(), "code", "NATION_7"), "country_id",
    ),
    """SELECT id, sensor_id, country_id FROM station
       WHERE country_id = (SELECT country_id FROM countries WHERE code = 'NATION_7')""",
)
register(
    "anti_new_rows",
    lambda t: joins.anti_new_rows(country_pages(t), "code", "page"),
    """WITH pages AS (SELECT n_name AS code, year(o_orderdate) - 1994 AS page FROM orders
                      JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
       seen AS (SELECT *, min(page) OVER (PARTITION BY code) AS first FROM pages)
       SELECT code, CAST(page AS BIGINT) AS page FROM seen WHERE page = first""",
)
register(
    "fk_orphans",
    lambda t: joins.fk_orphans(
        t.station("id", "sensor_id", "country_id"),
        t.countries().where(F.col("sources") > 4),
    ),
    """SELECT country_id, id, sensor_id FROM station
       WHERE country_id NOT IN (SELECT country_id FROM countries WHERE sources > 4)""",
)

# --- aggregates ---------------------------------------------------------------------


register("agg_count", lambda t: t.measurements().agg(agg.agg_count().alias("n")), "SELECT count(*) AS n FROM measurements")
register(
    "agg_count_col",
    lambda t: t.location_spans().agg(agg.agg_count_col("datetime_first").alias("n")),
    "SELECT count(datetime_first) AS n FROM locations",
)
register(
    "agg_count_distinct",
    lambda t: t.station("id", "sensor_id", "locality").agg(
        *[agg.agg_count_distinct(c).alias(c) for c in ("id", "sensor_id", "locality")]
    ),
    """SELECT count(DISTINCT id) AS id, count(DISTINCT sensor_id) AS sensor_id,
              count(DISTINCT locality) AS locality FROM station""",
)
register(
    "agg_count_distinct_expr",
    lambda t: t.station("id", "sensor_id", "extracted_at").agg(
        agg.agg_count_distinct(concat_key(F.col("id"), F.col("sensor_id"))).alias("keys"),
        agg.agg_count_distinct(F.struct("id", "sensor_id")).alias("pairs"),
        agg.agg_count_distinct(date_of(F.col("extracted_at"))).alias("days"),
    ),
    """SELECT count(DISTINCT id || '-' || sensor_id) AS keys, count(DISTINCT (id, sensor_id)) AS pairs,
              count(DISTINCT CAST(extracted_at AS DATE)) AS days FROM station""",
)
register(
    "agg_conditional",
    lambda t: t.measurements().agg(
        agg.agg_conditional(F.col("value") > 100).alias("high"), agg.agg_conditional(F.col("has_flags")).alias("flagged")
    ),
    "SELECT count(*) FILTER (value > 100) AS high, count(*) FILTER (has_flags) AS flagged FROM measurements",
)
register(
    "agg_min_max",
    lambda t: t.measurements().agg(
        F.min("value").alias("low"), F.max("value").alias("high"),
        F.min("period_from_utc").alias("first"), F.max("period_from_utc").alias("last"),
    ),
    """SELECT CAST(min(value) AS DOUBLE) AS low, CAST(max(value) AS DOUBLE) AS high,
              min(period_from_utc) AS first, max(period_from_utc) AS last FROM measurements""",
)
register(
    "agg_sum",
    lambda t: t.measurements().groupBy("sensor_id").agg(F.sum("value").alias("total")),
    "SELECT sensor_id, CAST(sum(value) AS DOUBLE) AS total FROM measurements GROUP BY ALL",
)
register(
    "agg_avg_round",
    lambda t: t.measurements().groupBy("sensor_id").agg(agg.agg_avg_round("value", 2).alias("mean")),
    f"SELECT sensor_id, {mean_sql('value', 2)} AS mean FROM measurements GROUP BY ALL",
)
register(
    "agg_stddev",
    lambda t: t.measurements().groupBy("sensor_id").agg(F.round(agg.agg_stddev("value"), 4).alias("sd")),
    "SELECT sensor_id, round(stddev_samp(value), 4) AS sd FROM measurements GROUP BY ALL",
)
register(
    "agg_string_agg",
    lambda t: agg.with_repeated_list(
        t.station("id", "sensor_name"), ["id"], "sensor_name", "sensor_names", "n", "rows"
    ),
    """SELECT id, string_agg(sensor_name, ', ' ORDER BY sensor_name) AS sensor_names, count(sensor_name) AS n,
              count(*) AS rows FROM station GROUP BY id""",
)
register(
    "agg_string_agg_distinct",
    lambda t: agg.with_distinct_list(t.station("id", "provider_name"), ["id"], "provider_name", "providers"),
    """SELECT id, string_agg(DISTINCT provider_name, ', ' ORDER BY provider_name) AS providers
       FROM station GROUP BY id""",
)
register(
    "agg_group_1",
    lambda t: t.station("provider_name").groupBy("provider_name").agg(agg.agg_count().alias("n")),
    "SELECT provider_name, count(*) AS n FROM station GROUP BY ALL",
)
register(
    "agg_group_n",
    lambda t: t.station("is_mobile", "is_monitor", "locality")
    .groupBy("is_mobile", "is_monitor", "locality").agg(agg.agg_count().alias("n")),
    "SELECT is_mobile, is_monitor, locality, count(*) AS n FROM station GROUP BY ALL",
)
register(
    "agg_group_expr",
    lambda t: t.measurements().groupBy(
        date_of(F.col("period_from_utc")).alias("day"), hour_of(F.col("period_from_utc")).alias("hour"),
        F.substring("raw_data", 1, 6).alias("start"),
    ).agg(agg.agg_count().alias("n")),
    """SELECT CAST(period_from_utc AS DATE) AS day, CAST(hour(period_from_utc) AS BIGINT) AS hour,
              substr(raw_data, 1, 6) AS start, count(*) AS n FROM measurements GROUP BY ALL""",
)
register(
    "agg_having",
    lambda t: t.measurements().groupBy("sensor_id", "period_from_utc").agg(agg.agg_count().alias("n")).where("n > 1"),
    "SELECT sensor_id, period_from_utc, count(*) AS n FROM measurements GROUP BY ALL HAVING count(*) > 1",
)
register(
    "distinct_rows",
    lambda t: t.station("id", "name", "provider_name").distinct(),
    "SELECT DISTINCT id, name, provider_name FROM station",
)
register(
    "agg_ratio",
    lambda t: t.station("id", "sensor_id", "sensor_name").groupBy("id").agg(
        F.round(
            agg.agg_ratio(
                agg.agg_count_distinct("sensor_name").cast("decimal(18,0)"), agg.agg_count_col("sensor_id").cast("decimal(18,0)")
            ),
            4,
        ).alias("ratio")
    ),
    """SELECT id, CAST((2 * count(DISTINCT sensor_name) * 10000 + count(sensor_id)) // (2 * count(sensor_id)) / 10000.0 AS DOUBLE) AS ratio
       FROM station GROUP BY id""",
)

# --- order --------------------------------------------------------------------------

register(
    "latest_per_key",
    lambda t: ordering.latest_per_key(
        t.measurements().select("sensor_id", "parameter_name", "value", "arrived_at", "id"),
        ["sensor_id", "parameter_name"], ["arrived_at", "id"],
    ),
    f"""SELECT sensor_id, parameter_name, {_VALUE}, arrived_at, id FROM (
          SELECT *, row_number() OVER (PARTITION BY sensor_id, parameter_name ORDER BY arrived_at DESC, id DESC) AS rn
          FROM measurements) WHERE rn = 1""",
)
_BUDGET = 2000
register(
    "budget_cutoff",
    lambda t: ordering.budget_cutoff(t.measurements().select("id", "sensor_id"), "sensor_id", _BUDGET),
    f"""WITH n AS (SELECT sensor_id, count(*) AS n FROM measurements GROUP BY ALL),
        running AS (SELECT sensor_id, COALESCE(sum(n) OVER (ORDER BY sensor_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
        SELECT id, sensor_id FROM measurements WHERE sensor_id IN (SELECT sensor_id FROM running WHERE before < {_BUDGET})""",
)
register(
    "sort_multi",
    lambda t: ordering.sort_multi(t.station("id", "sensor_id", "locality", "extracted_at"), "locality", "-extracted_at", "id", "sensor_id"),
    "SELECT id, sensor_id, locality, extracted_at FROM station ORDER BY locality, extracted_at DESC",
)
register(
    "sort_case",
    lambda t: ordering.sort_multi(
        t.measurements().groupBy("parameter_name").agg(agg.agg_count().alias("n")),
        labels.parameter_rank(F.col("parameter_name")), "parameter_name",
    ).withColumn("rank", labels.parameter_rank(F.col("parameter_name")).cast("bigint")),
    """SELECT parameter_name, count(*) AS n, CAST(CASE parameter_name WHEN 'pm25' THEN 1 WHEN 'pm10' THEN 2 WHEN 'no2' THEN 3
              WHEN 'co' THEN 4 WHEN 'o3' THEN 5 WHEN 'so2' THEN 6 ELSE 7 END AS BIGINT) AS rank FROM measurements GROUP BY ALL""",
)
register(
    "sort_expr",
    lambda t: ordering.sort_multi(
        t.location_spans(), (F.col("datetime_last") - F.col("datetime_first")).desc_nulls_first(), "location_id"
    ).select("location_id", "datetime_first", "datetime_last"),
    "SELECT location_id, datetime_first, datetime_last FROM locations ORDER BY datetime_last - datetime_first DESC",
)
register(
    "topk",
    lambda t: ordering.topk(t.measurements().select("id", "sensor_id", "value"), 15, "-value", "id"),
    f"SELECT id, sensor_id, {_VALUE} FROM measurements ORDER BY measurements.value DESC, id LIMIT 15",
)
register(
    "limit_sample",
    lambda t: ordering.limit_sample(t.station("id", "sensor_id"), 2).agg(agg.agg_count().alias("n")),
    "SELECT count(*) AS n FROM (SELECT id FROM station LIMIT 2)",
)

# --- metric rows ----------------------------------------------------------------------

register(
    "union_metrics",
    lambda t: metrics.union_metrics(
        t.measurements(),
        {
            "rows": agg.agg_count(),
            "sensors": agg.agg_count_distinct("sensor_id"),
            "flagged": agg.agg_conditional(F.col("has_flags")),
        },
    ),
    """SELECT 'rows' AS metric, count(*) AS value FROM measurements
       UNION ALL SELECT 'sensors', count(DISTINCT sensor_id) FROM measurements
       UNION ALL SELECT 'flagged', count(*) FROM measurements WHERE has_flags""",
)
register(
    "union_checks",
    lambda t: metrics.union_checks(
        t.location_spans(),
        {
            "no first date": F.col("datetime_first").isNull(),
            "no sensors": F.col("sensors") == "[]",
            "no position": F.col("latitude").isNull() | F.col("longitude").isNull(),
        },
    ),
    """SELECT 'no first date' AS problem, count(*) AS found FROM locations WHERE datetime_first IS NULL
       UNION ALL SELECT 'no sensors', count(*) FROM locations WHERE sensors = '[]'
       UNION ALL SELECT 'no position', count(*) FROM locations WHERE latitude IS NULL OR longitude IS NULL""",
)
