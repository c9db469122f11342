"""The composed reports: measurements, countries, stations and checks."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.bindings import COUNTRIES_AS_OF, MEASUREMENTS_AS_OF, Model
from brisa.catalog.base import dbl, mean_sql, query, ratio_sql, register
from brisa.functions import labels
from brisa.operators.filters import midnight
from brisa.plans import countries as ctry
from brisa.plans import measurements as meas
from brisa.plans import quality, stations

NOW = MEASUREMENTS_AS_OF
TODAY = midnight(NOW).date()
C_NOW = COUNTRIES_AS_OF


def since(days: int) -> date:
    return TODAY - timedelta(days=days)


def _since_sql(days: int) -> str:
    return f"period_from_utc >= TIMESTAMP '{since(days)} 00:00:00'"


def _bands_sql(x: str, bands, otherwise: str, op: str) -> str:
    cases = " ".join(f"WHEN {x} {op} {limit} THEN '{text}'" for limit, text in bands)
    return f"CASE {cases} ELSE '{otherwise}' END"


def _who_sql() -> str:
    cases = " ".join(
        f"WHEN '{name}' THEN {_bands_sql('mean_value', limits, above, '<=')}"
        for name, (limits, above) in labels.WHO_LIMITS.items()
    )
    return f"CASE parameter_name {cases} ELSE '{labels.WHO_ELSE}' END"


_RANGE = f"{dbl('min(value)')} AS min_value, {dbl('max(value)')} AS max_value"
_SD = "round(stddev_samp(value), 2) AS sd_value"


# --- measurements -------------------------------------------------------------

register(
    "m_pm25_daily",
    lambda t: meas.m_pm25_daily(t.measurements(since(7), ("pm25",)), NOW, 7),
    f"""SELECT CAST(period_from_utc AS DATE) AS day, count(*) AS n,
               {mean_sql('value', 2)} AS mean_pm25, {_RANGE}, {_SD}
        FROM measurements WHERE parameter_name = 'pm25' AND {_since_sql(7)} GROUP BY ALL""",
)

register(
    "m_pm25_exceed",
    lambda t: meas.m_pm25_exceed(t.measurements(parameters=("pm25",))),
    f"""WITH daily AS (
          SELECT CAST(period_from_utc AS DATE) AS day, count(*) AS n, {mean_sql('value', 2)} AS mean_pm25, {_RANGE}
          FROM measurements WHERE parameter_name = 'pm25' GROUP BY ALL)
        SELECT day, mean_pm25, round(mean_pm25 - 25, 2) AS excess,
               round((mean_pm25 - 25) / 25 * 100, 1) AS excess_percent, n, min_value, max_value,
               {_bands_sql('mean_pm25', labels.PM25_EXCESS_BANDS, labels.PM25_EXCESS_ELSE, '>')} AS category
        FROM daily WHERE mean_pm25 > 25""",
)

_NO2 = f"""
    WITH per_sensor AS (
      SELECT sensor_id, location_id, parameter_units, count(*) AS n, {mean_sql('value', 2)} AS mean_no2, {_RANGE}, {_SD},
             min(period_from_utc) AS first_period, max(period_from_utc) AS last_period
      FROM measurements WHERE parameter_name = 'no2' AND {_since_sql(3)} GROUP BY ALL)
    SELECT sensor_id, l.name AS location_name, mean_no2, parameter_units, n, min_value, max_value, sd_value,
           first_period, last_period,
           CAST(epoch(last_period) - epoch(first_period) AS BIGINT) // 86400 AS days_monitored,
           {_bands_sql('mean_no2', labels.NO2_BANDS, labels.NO2_ELSE, '>')} AS category
    FROM per_sensor JOIN locations l USING (location_id)
    ORDER BY mean_no2 DESC, sensor_id LIMIT {{k}}"""

register(
    "m_no2_top",
    lambda t: meas.m_no2_top(t.measurements(since(3), ("no2",)), t.locations(), NOW, 3, k=10),
    _NO2.format(k=10),
)
register(
    "m_no2_top1",
    lambda t: meas.m_no2_top(t.measurements(since(3), ("no2",)), t.locations(), NOW, 3, k=1),
    _NO2.format(k=1),
)

register(
    "m_weekly_summary",
    lambda t: meas.m_weekly_summary(t.measurements(since(7)), NOW, 7),
    f"""SELECT parameter_name, parameter_units, count(*) AS n, {mean_sql('value', 2)} AS mean_value, {_RANGE}, {_SD},
               count(DISTINCT sensor_id) AS active_sensors,
               min(period_from_utc) AS first_period, max(period_from_utc) AS last_period
        FROM measurements WHERE {_since_sql(7)} GROUP BY ALL""",
)

register(
    "m_hourly_profile",
    lambda t: meas.m_hourly_profile(t.measurements(parameters=meas.HOURLY_PARAMETERS)),
    f"""SELECT CAST(hour(period_from_utc) AS BIGINT) AS hour_utc, parameter_name, count(*) AS n,
               {mean_sql('value', 2)} AS mean_value, {_RANGE}
        FROM measurements WHERE parameter_name IN ('pm25', 'pm10', 'no2', 'co', 'o3') GROUP BY ALL""",
)

register(
    "m_who_daily",
    lambda t: meas.m_who_daily(t.measurements(since(7)), NOW, 7),
    f"""WITH daily AS (
          SELECT CAST(period_from_utc AS DATE) AS day, parameter_name, {mean_sql('value', 2)} AS mean_value, count(*) AS n
          FROM measurements WHERE {_since_sql(7)} GROUP BY ALL)
        SELECT *, {_who_sql()} AS who_rating FROM daily""",
)

register(
    "m_spikes",
    lambda t: meas.m_spikes(t.measurements(since(7)), NOW, 7, history=t.measurements()),
    f"""WITH stats AS (
          SELECT parameter_name, avg(value) AS mean_x, stddev_samp(value) AS sd_x, {mean_sql('value', 2)} AS mean_all
          FROM measurements GROUP BY parameter_name)
        SELECT sensor_id, m.parameter_name, period_from_utc, {dbl('value')} AS measured, mean_all,
               round(CAST(value AS DOUBLE) - mean_x, 2) AS difference,
               round((CAST(value AS DOUBLE) - mean_x) / sd_x, 2) AS deviations
        FROM measurements m JOIN stats s ON m.parameter_name = s.parameter_name
        WHERE CAST(value AS DOUBLE) > mean_x + 2 * sd_x AND {_since_sql(7)}
        ORDER BY deviations DESC, sensor_id, m.parameter_name, period_from_utc, measured LIMIT 20""",
)

register(
    "m_availability",
    lambda t: meas.m_availability(t.measurements(), t.locations()),
    f"""WITH per_sensor AS (
          SELECT sensor_id, parameter_name, location_id, count(*) AS n,
                 min(period_from_utc) AS first_period, max(period_from_utc) AS last_period
          FROM measurements GROUP BY ALL),
        spans AS (SELECT *, CAST(epoch(last_period) - epoch(first_period) AS BIGINT) // 3600 AS h FROM per_sensor)
        SELECT sensor_id, parameter_name, l.name AS location_name, n, first_period, last_period,
               CAST(h AS DOUBLE) AS hours, {ratio_sql('n', 'h', 2)} AS per_hour,
               CASE WHEN h > 0 THEN {_bands_sql('n', [(f'{b} * h', x) for b, x in labels.AVAILABILITY_BANDS],
                                                labels.AVAILABILITY_ELSE, '>=')} END AS data_quality
        FROM spans LEFT JOIN locations l USING (location_id)""",
)

# --- countries ----------------------------------------------------------------

_DAYS_SINCE = f"CAST(epoch(TIMESTAMP '{C_NOW}') - epoch(\"datetimeLast\") AS BIGINT) // 86400"


def _country(key: str, sql: str, *args, **kwargs) -> None:
    register(key, lambda t: getattr(ctry, key)(t.countries(), *args, **kwargs), sql)


_country(
    "c_overview",
    """SELECT count(*) AS countries, count(DISTINCT code) AS codes, count(DISTINCT country_id) AS ids,
              CAST(sum(locations) AS BIGINT) AS locations, CAST(sum(sources) AS BIGINT) AS sources,
              min(extracted_at) AS first_load, max(extracted_at) AS last_load FROM countries""",
)
_country(
    "c_top_locations",
    """SELECT code, name, locations, sources, CAST(json_array_length(parameters) AS BIGINT) AS parameter_count,
              "datetimeFirst", "datetimeLast"
       FROM countries WHERE locations > 0 ORDER BY locations DESC, code LIMIT 10""",
)
_country(
    "c_top_parameters",
    """SELECT code, name, CAST(json_array_length(parameters) AS BIGINT) AS parameter_count, parameters, locations, sources
       FROM countries WHERE json_array_length(parameters) > 0
       ORDER BY parameter_count DESC, locations DESC, code LIMIT 15""",
)
_country(
    "c_most_recent",
    f"""SELECT code, name, "datetimeLast", locations, sources, {_DAYS_SINCE} AS days_since
        FROM countries WHERE "datetimeLast" IS NOT NULL ORDER BY "datetimeLast" DESC, code LIMIT 10""",
    C_NOW,
)


def _region_sql(text: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains({text}, '{h}')" for h in hours) + f" THEN '{region}'"
        for hours, region in labels.REGION_HOURS
    )
    return f"CASE {cases} ELSE '{labels.REGION_ELSE}' END"


_country(
    "c_by_region",
    f"""SELECT {_region_sql('"datetimeFirst_raw"')} AS region, count(*) AS countries,
               CAST(sum(locations) AS BIGINT) AS locations, CAST(sum(sources) AS BIGINT) AS sources
        FROM countries WHERE "datetimeFirst" IS NOT NULL GROUP BY ALL""",
)
_country(
    "c_parameter_usage",
    """SELECT parameter, count(*) AS countries, CAST(sum(locations) AS BIGINT) AS locations,
              string_agg(code, ', ' ORDER BY code) AS codes
       FROM (SELECT code, locations, unnest(from_json(parameters, '["VARCHAR"]')) AS parameter FROM countries)
       GROUP BY parameter""",
)
_country(
    "c_stale",
    f"""SELECT code, name, locations, "datetimeLast", {_DAYS_SINCE} AS days_inactive FROM countries
        WHERE "datetimeLast" < TIMESTAMP '{C_NOW}' - INTERVAL 10 DAY AND locations > 0""",
    C_NOW,
    days=10,
)
_country(
    "c_start_year",
    """SELECT CAST(year("datetimeFirst") AS BIGINT) AS start_year, count(*) AS countries,
              string_agg(code, ', ' ORDER BY code) AS codes
       FROM countries WHERE "datetimeFirst" IS NOT NULL GROUP BY ALL""",
)
_country(
    "c_density",
    f"""SELECT code, name, locations, sources,
               COALESCE({ratio_sql('locations', 'sources', 2)}, 0) AS locations_per_source,
               CAST(json_array_length(parameters) AS BIGINT) AS parameter_count
        FROM countries WHERE locations > 0 AND sources > 0 ORDER BY locations_per_source DESC, code LIMIT 15""",
)
_LATIN = ("NATION_1", "NATION_2", "NATION_3", "NATION_17", "NATION_24")
_country(
    "c_latin_america",
    f"""SELECT code, name, locations, sources, parameters, "datetimeFirst", "datetimeLast"
        FROM countries WHERE code IN {_LATIN}""",
    _LATIN,
)
_country(
    "c_load_days",
    """SELECT CAST(extracted_at AS DATE) AS load_day, count(*) AS rows, count(DISTINCT code) AS codes,
              min(extracted_at) AS first_load, max(extracted_at) AS last_load FROM countries GROUP BY ALL""",
)
_country(
    "c_with_pm",
    """SELECT code, name, locations, parameters FROM countries
       WHERE parameters LIKE '%pm25%' OR parameters LIKE '%pm10%'""",
)
_country(
    "c_integrity",
    f"""SELECT '{ctry.DUPLICATED_CODES}' AS problem, count(*) AS found
          FROM (SELECT code FROM countries WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1)
        UNION ALL SELECT '{ctry.DUPLICATED_IDS}', count(*)
          FROM (SELECT country_id FROM countries WHERE country_id IS NOT NULL GROUP BY country_id HAVING count(*) > 1)
        UNION ALL SELECT '{ctry.WITHOUT_CODE}', count(*) FROM countries WHERE code IS NULL
        UNION ALL SELECT '{ctry.WITHOUT_NAME}', count(*) FROM countries WHERE name IS NULL""",
)

_country("lc_count", "SELECT count(*) AS countries FROM countries")
_country("lc_list", 'SELECT code, name, "datetimeFirst", "datetimeLast" FROM countries')
_country(
    "lc_recent10",
    'SELECT code, name, "datetimeLast" FROM countries ORDER BY "datetimeLast" DESC, code LIMIT 10',
)
_country(
    "lc_oldest10",
    'SELECT code, name, "datetimeFirst" FROM countries ORDER BY "datetimeFirst", code LIMIT 10',
)
_country(
    "lc_param_rich",
    """SELECT code, name, CAST(json_array_length(parameters) AS BIGINT) AS parameter_count, "datetimeFirst"
       FROM countries WHERE json_array_length(parameters) > 0 ORDER BY parameter_count DESC, code LIMIT 15""",
)
_country("lc_params_of", "SELECT name, parameters FROM countries WHERE code = 'NATION_4'", "NATION_4")
_country(
    "lc_start_year",
    """SELECT substr("datetimeFirst_raw", 1, 4) AS start_year, count(*) AS countries FROM countries
       WHERE "datetimeFirst" IS NOT NULL GROUP BY ALL""",
)
_country(
    "lc_duration",
    """SELECT code, name,
              CAST(round((epoch("datetimeLast") - epoch("datetimeFirst")) / 86400.0) AS BIGINT) AS days_monitored
       FROM countries ORDER BY days_monitored DESC, code LIMIT 10""",
)
_SETS = {
    "lc_america": ("NATION_1", "NATION_2", "NATION_3", "NATION_17", "NATION_24"),
    "lc_europe": ("NATION_6", "NATION_7", "NATION_19", "NATION_22", "NATION_23"),
    "lc_asia": ("NATION_8", "NATION_9", "NATION_12", "NATION_18", "NATION_21"),
}
for _key, _codes in _SETS.items():
    _country(_key, f'SELECT code, name, "datetimeFirst" FROM countries WHERE code IN {_codes}', _codes)
_LAST_DAY = "2001-07-30 12:00:00"
_country(
    "lc_coverage",
    """SELECT 'Total países' AS metric, count(*) AS value FROM countries
       UNION ALL SELECT 'Con fecha inicio', count(*) FROM countries WHERE "datetimeFirst" IS NOT NULL
       UNION ALL SELECT 'Con fecha última', count(*) FROM countries WHERE "datetimeLast" IS NOT NULL
       UNION ALL SELECT 'Activos hoy', count(*) FROM countries WHERE CAST("datetimeLast" AS DATE) = DATE '2001-07-30'""",
    _LAST_DAY,
)
_country(
    "lc_last24h",
    f"""SELECT code, name, "datetimeLast" FROM countries
        WHERE "datetimeLast" > TIMESTAMP '{_LAST_DAY}' - INTERVAL 1 DAY""",
    _LAST_DAY,
)
_country(
    "lc_loads",
    "SELECT min(extracted_at) AS first_load, max(extracted_at) AS last_load, count(*) AS rows FROM countries",
)
_country("lc_dup_codes", "SELECT code, count(*) AS duplicates FROM countries GROUP BY code HAVING count(*) > 1")
_country(
    "lc_pm25_and_pm10",
    """SELECT code, name, parameters FROM countries
       WHERE parameters LIKE '%pm25%' AND parameters LIKE '%pm10%'""",
)
_country("lc_o3", "SELECT code, name, parameters FROM countries WHERE parameters LIKE '%o3%'")
_country("lc_no2", "SELECT code, name, parameters FROM countries WHERE parameters LIKE '%no2%'")

# --- stations -----------------------------------------------------------------


def _station(key: str, columns: str, sql: str, *args, **kwargs) -> None:
    register(key, lambda t: getattr(stations, key)(t.station(*columns.split()), *args, **kwargs), sql)


def _combined(key: str, columns: str, sql: str, *args, **kwargs) -> None:
    """A report on rows that are combined before the dimensions are joined."""
    register(key, lambda t: getattr(stations, key)(t.station(*columns.split(), combined=True), *args, **kwargs), sql)


register(
    "s_overview",
    lambda t: stations.s_overview(t.station("id", "sensor_id", "provider_id", "locality", "extracted_at", sides=True)),
    """SELECT count(*) AS rows, count(DISTINCT id) AS stations, count(DISTINCT sensor_id) AS sensors,
              count(DISTINCT provider_id) AS providers, count(DISTINCT locality) AS localities,
              min(extracted_at) AS first_load, max(extracted_at) AS last_load FROM station""",
)
_combined(
    "s_top_sensors", "id name locality provider_name sensor_id sensor_name",
    """SELECT id, name, locality, provider_name, count(DISTINCT sensor_id) AS sensors,
              string_agg(DISTINCT sensor_name, ', ' ORDER BY sensor_name) AS sensor_names
       FROM station GROUP BY id, name, locality, provider_name
       ORDER BY sensors DESC, id, name, locality, provider_name LIMIT 15""",
)
_combined(
    "s_by_provider", "id provider_name provider_id sensor_name",
    """SELECT provider_name, provider_id, count(DISTINCT id) AS stations, count(*) AS rows,
              count(DISTINCT sensor_name) AS sensor_names
       FROM station WHERE provider_name IS NOT NULL GROUP BY ALL""",
)
_combined(
    "s_sensor_types", "id provider_id sensor_name",
    """SELECT sensor_name, count(*) AS rows, count(DISTINCT id) AS stations, count(DISTINCT provider_id) AS providers
       FROM station WHERE sensor_name IS NOT NULL GROUP BY ALL""",
)
_combined(
    "s_by_locality", "id locality provider_name latitude longitude",
    f"""SELECT locality, count(DISTINCT id) AS stations, count(*) AS rows,
               count(DISTINCT provider_name) AS providers, {mean_sql('latitude', 6, 8)} AS mean_latitude,
               {mean_sql('longitude', 6, 8)} AS mean_longitude
        FROM station WHERE locality IS NOT NULL GROUP BY locality""",
)
_combined(
    "s_with_coords", "id name locality latitude longitude provider_name sensor_name",
    """SELECT id, name, locality, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
              provider_name, count(*) AS sensors, string_agg(sensor_name, ', ' ORDER BY sensor_name) AS sensor_names
       FROM station WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL""",
)
_combined(
    "s_mobile_monitor", "id is_mobile is_monitor sensor_name",
    """SELECT is_mobile, is_monitor, count(DISTINCT id) AS stations, count(*) AS rows,
              count(DISTINCT sensor_name) AS sensor_names FROM station GROUP BY ALL""",
)
_combined(
    "s_by_timezone", "id timezone locality",
    """SELECT timezone, count(DISTINCT id) AS stations, count(*) AS rows,
              string_agg(DISTINCT locality, ', ' ORDER BY locality) AS localities
       FROM station WHERE timezone IS NOT NULL GROUP BY timezone""",
)
_ALL = (
    "id name locality latitude longitude timezone provider_name sensor_id sensor_name "
    "is_mobile is_monitor extracted_at"
)
_LAT_LON = "CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude"
_station(
    "s_detail", _ALL,
    f"""SELECT id, name, locality, {_LAT_LON}, timezone, provider_name, sensor_id, sensor_name,
               is_mobile, is_monitor, extracted_at FROM station WHERE id = 7""",
    7,
)
_combined(
    "s_search_locality", "id name locality provider_name latitude longitude sensor_name",
    f"""SELECT id, name, locality, provider_name, count(*) AS sensors, {_LAT_LON},
               string_agg(sensor_name, ', ' ORDER BY sensor_name) AS sensor_names
        FROM station WHERE locality ILIKE '%nation_2%' GROUP BY ALL""",
    "%nation_2%",
)
register(
    "s_by_country",
    lambda t: stations.s_by_country(t.station("id", "country_id", "provider_name", combined=True), t.countries()),
    """SELECT c.code AS country_code, c.name AS country_name, count(DISTINCT s.id) AS stations,
              count(s.id) AS rows, count(DISTINCT s.provider_name) AS providers
       FROM station s JOIN countries c ON s.country_id = c.country_id GROUP BY ALL""",
)
_combined(
    "s_variety", "id name locality provider_name sensor_id sensor_name",
    f"""WITH v AS (SELECT id, name, locality, provider_name, count(DISTINCT sensor_name) AS variety,
                          count(sensor_id) AS sensors FROM station GROUP BY ALL)
        SELECT *, {ratio_sql('variety', 'sensors', 2)} AS variety_ratio FROM v WHERE sensors > 1
        ORDER BY variety DESC, sensors DESC, id, name, locality, provider_name LIMIT 20""",
)
_station(
    "s_load_days", "id sensor_id extracted_at",
    """SELECT CAST(extracted_at AS DATE) AS load_day, count(*) AS rows, count(DISTINCT id) AS stations,
              count(DISTINCT sensor_id) AS sensors, min(extracted_at) AS first_load, max(extracted_at) AS last_load
       FROM station GROUP BY ALL""",
)
_PATTERNS = ("%econ%", "%promo%")
_station(
    "s_search_sensor", "id name locality latitude longitude provider_name sensor_name sensor_id",
    f"""SELECT id, name, locality, {_LAT_LON}, provider_name, sensor_name, sensor_id FROM station
        WHERE sensor_name ILIKE '%econ%' OR sensor_name ILIKE '%promo%'""",
    _PATTERNS,
)
_station(
    "s_integrity", "id sensor_id name latitude longitude provider_name",
    """SELECT 'Registros sin ID de estación' AS problem, count(*) AS found FROM station WHERE id IS NULL
       UNION ALL SELECT 'Registros sin ID de sensor', count(*) FROM station WHERE sensor_id IS NULL
       UNION ALL SELECT 'Registros sin nombre de estación', count(*) FROM station WHERE name IS NULL
       UNION ALL SELECT 'Registros sin coordenadas', count(*) FROM station WHERE latitude IS NULL OR longitude IS NULL
       UNION ALL SELECT 'Registros sin proveedor', count(*) FROM station WHERE provider_name IS NULL""",
)
_BOX = """SELECT CAST(min(latitude) AS DOUBLE) AS min_latitude, CAST(max(latitude) AS DOUBLE) AS max_latitude,
                 CAST(min(longitude) AS DOUBLE) AS min_longitude, CAST(max(longitude) AS DOUBLE) AS max_longitude,
                 count(DISTINCT id) AS stations FROM station"""
_combined(
    "s_bbox_density", "id latitude longitude",
    f"""WITH box AS ({_BOX}),
        sized AS (SELECT *, (max_latitude - min_latitude) * (max_longitude - min_longitude) AS a FROM box)
        SELECT * EXCLUDE (a), round(a, 4) AS area, round(stations / a, 2) AS density FROM sized""",
)
_combined(
    "s_quadrants", "id locality latitude longitude",
    """SELECT CASE WHEN latitude >= -30 AND longitude >= -70 THEN 'Norte-Este' WHEN latitude >= -30 THEN 'Norte-Oeste'
                   WHEN longitude >= -70 THEN 'Sur-Este' ELSE 'Sur-Oeste' END AS quadrant,
              count(DISTINCT id) AS stations, string_agg(DISTINCT locality, ', ' ORDER BY locality) AS localities
       FROM station GROUP BY 1""",
)

_station("ls_count", "id", "SELECT count(*) AS rows FROM station")
_station("ls_count_stations", "id", "SELECT count(DISTINCT id) AS stations FROM station")
_station(
    "ls_list", "id name locality sensor_id sensor_name provider_name",
    "SELECT id, name, locality, sensor_name, provider_name FROM station",
)
_combined(
    "ls_unique", "id name locality provider_name latitude longitude",
    f"SELECT DISTINCT id, name, locality, provider_name, {_LAT_LON} FROM station",
)
_combined(
    "ls_by_provider", "id provider_name",
    "SELECT provider_name, count(*) AS rows, count(DISTINCT id) AS stations FROM station GROUP BY ALL",
)
_combined(
    "ls_sensor_types", "sensor_name",
    "SELECT sensor_name, count(*) AS rows FROM station WHERE sensor_name IS NOT NULL GROUP BY ALL",
)
_combined(
    "ls_top_sensors", "id name locality",
    """SELECT id, name, locality, count(*) AS rows FROM station GROUP BY ALL
       ORDER BY rows DESC, id LIMIT 15""",
)
_station(
    "ls_with_sensor", "name locality provider_name sensor_name",
    "SELECT DISTINCT name, locality, provider_name FROM station WHERE sensor_name ILIKE '%econ%'",
    "%econ%",
)
_combined(
    "ls_by_locality", "id locality",
    "SELECT locality, count(DISTINCT id) AS stations FROM station WHERE locality IS NOT NULL GROUP BY ALL",
)
_station(
    "ls_in_city", "id name sensor_id sensor_name latitude longitude locality",
    f"SELECT name, sensor_name, {_LAT_LON} FROM station WHERE locality ILIKE '%Nation_1%'",
    "%Nation_1%",
)
_combined("ls_bbox", "id latitude longitude", _BOX)
register(
    "ls_country_counts",
    lambda t: stations.ls_country_counts(t.countries(), t.station("id", "country_id", combined=True)),
    """SELECT c.name, c.code, count(s.id) AS rows, count(DISTINCT s.id) AS stations
       FROM countries c LEFT JOIN station s ON c.country_id = s.country_id
       GROUP BY ALL HAVING count(s.id) > 0""",
)
register(
    "ls_country_detail",
    lambda t: stations.ls_country_detail(
        t.countries(), t.station("name", "locality", "sensor_name", "country_id"), "NATION_7"
    ),
    """SELECT c.name AS country_name, c.code AS country_code, s.name AS station_name, s.locality, s.sensor_name
       FROM countries c JOIN station s ON c.country_id = s.country_id WHERE c.code = 'NATION_7'
       ORDER BY s.name, s.sensor_name LIMIT 20""",
)
_station(
    "ls_key_check", "id sensor_id",
    "SELECT count(*) AS rows, count(DISTINCT id || '-' || sensor_id) AS keys FROM station",
)
_station(
    "ls_dup_keys", "id sensor_id",
    "SELECT id, sensor_id, count(*) AS duplicates FROM station GROUP BY ALL HAVING count(*) > 1",
)
_station(
    "ls_dup_sensor_type", "id name sensor_name",
    "SELECT id, name, sensor_name, count(*) AS rows FROM station GROUP BY ALL HAVING count(*) > 1",
)
_CITIES = ("NATION_5", "NATION_6", "NATION_19")
_station(
    "ls_main_cities", "id sensor_id locality name sensor_name provider_name",
    f"SELECT locality, name, sensor_name, provider_name FROM station WHERE locality IN {_CITIES}",
    _CITIES,
)
_station(
    "ls_metro", "id sensor_id locality name sensor_name latitude longitude",
    f"""SELECT name, locality, sensor_name, {_LAT_LON} FROM station
        WHERE locality ILIKE '%nation_8%' OR locality ILIKE '%NATION_10%' OR locality ILIKE '%Nation_15%'""",
    ("%nation_8%", "%NATION_10%", "%Nation_15%"),
)
_station(
    "ls_pm", "name locality provider_name sensor_name",
    """SELECT DISTINCT name, locality, provider_name FROM station WHERE sensor_name IN ('ECONOMY', 'PROMO')""",
    ("ECONOMY", "PROMO"),
)
_station(
    "ls_gases", "name locality sensor_name",
    """SELECT DISTINCT name, locality, sensor_name FROM station WHERE sensor_name IN ('STANDARD', 'SMALL', 'LARGE')""",
    ("STANDARD", "SMALL", "LARGE"),
)
_station(
    "ls_complete", "id name locality sensor_name",
    """SELECT id, name, locality, string_agg(DISTINCT sensor_name, ',' ORDER BY sensor_name) AS sensor_names,
              count(DISTINCT sensor_name) AS sensor_types
       FROM station GROUP BY id, name, locality HAVING count(DISTINCT sensor_name) >= 3""",
)
register(
    "ls_report",
    lambda t: stations.ls_report(t.station("id", "sensor_name", "locality", "provider_name", sides=True)),
    """SELECT 'Total registros' AS metric, count(*) AS value FROM station
       UNION ALL SELECT 'Estaciones únicas', count(DISTINCT id) FROM station
       UNION ALL SELECT 'Tipos de sensores', count(DISTINCT sensor_name) FROM station
       UNION ALL SELECT 'Localidades', count(DISTINCT locality) FROM station
       UNION ALL SELECT 'Proveedores', count(DISTINCT provider_name) FROM station""",
)
_CATEGORY = """CASE WHEN {x} ILIKE '%pm%' THEN 'Partículas (PM)'
     WHEN {x} ILIKE '%no%' OR {x} ILIKE '%so%' OR {x} ILIKE '%o3%' THEN 'Gases'
     WHEN {x} ILIKE '%temp%' OR {x} ILIKE '%hum%' THEN 'Meteorológicos' ELSE 'Otros' END"""
_combined(
    "ls_sensor_category", "sensor_name",
    f"SELECT {_CATEGORY.format(x='sensor_name')} AS category, count(*) AS rows FROM station GROUP BY 1",
)
_combined(
    "ls_top10", "name locality provider_name",
    """SELECT name, locality, provider_name, count(*) AS rows FROM station GROUP BY ALL
       ORDER BY rows DESC, name, locality, provider_name LIMIT 10""",
)
_combined(
    "ls_by_city", "id locality",
    """SELECT locality, count(DISTINCT id) AS stations, count(*) AS rows FROM station
       WHERE locality IS NOT NULL GROUP BY ALL""",
)

# --- checks -------------------------------------------------------------------

register(
    "v_validate",
    lambda t: quality.v_validate(t.countries(), t.locations(), t.parameters()),
    """SELECT 'countries' AS table_name, count(*) AS rows, count(DISTINCT code) AS distinct_values FROM countries
       UNION ALL SELECT 'locations', count(*), count(DISTINCT country_code) FROM locations
       UNION ALL SELECT 'parameters', count(*), count(DISTINCT name) FROM parameters""",
)
register(
    "v_iso_codes",
    lambda t: quality.v_iso_codes(t.countries()),
    "SELECT DISTINCT code FROM countries WHERE code IS NOT NULL",
)
register(
    "v_locality_sensors",
    lambda t: quality.v_locality_sensors(t.locations(), "NATION_3", "%mach%", ("locality", "name")),
    """SELECT * FROM (
         SELECT location_id * 10 AS sensor_id, location_id, name AS location_name,
                CASE location_id % 3 WHEN 0 THEN 'pm25' ELSE 'o3' END AS parameter_name,
                CASE location_id % 3 WHEN 0 THEN 'ug/m3' ELSE 'ppm' END AS parameter_units
         FROM locations WHERE location_id % 3 <> 1 AND country_code = 'NATION_3'
           AND (lower(locality) LIKE '%mach%' OR lower(name) LIKE '%mach%')
         UNION ALL
         SELECT location_id * 10 + 1, location_id, name, 'N/A', 'N/A'
         FROM locations WHERE location_id % 3 = 0 AND country_code = 'NATION_3'
           AND (lower(locality) LIKE '%mach%' OR lower(name) LIKE '%mach%'))
       WHERE sensor_id <> 0""",
)
register(
    "v_sensor_counts",
    lambda t: quality.v_sensor_counts(t.measurements()),
    "SELECT sensor_id, parameter_name, count(*) AS n FROM measurements GROUP BY ALL",
)
register(
    "v_country_sample",
    lambda t: quality.v_country_sample(t.countries()),
    """SELECT country_id, code, name, "datetimeFirst", "datetimeLast" FROM countries
       ORDER BY name, country_id LIMIT 10""",
)
register(
    "v_country_dups",
    lambda t: quality.v_country_dups(t.countries()),
    "SELECT code, count(*) AS n FROM countries GROUP BY code HAVING count(*) > 1",
)
register(
    "v_country_duration",
    lambda t: quality.v_country_duration(t.countries()).withColumn(
        "duration", F.extract(F.lit("DAY"), "duration").cast("bigint")
    ),
    """SELECT code, name, CAST(year("datetimeFirst") AS BIGINT) AS first_year,
              CAST(year("datetimeLast") AS BIGINT) AS last_year,
              CAST(epoch("datetimeLast") - epoch("datetimeFirst") AS BIGINT) // 86400 AS duration
       FROM countries ORDER BY "datetimeLast" - "datetimeFirst" DESC, code LIMIT 5""",
)
register(
    "v_country_params",
    lambda t: quality.v_country_params(t.countries()),
    """SELECT code, name, CAST(json_array_length(parameters) AS BIGINT) AS parameter_count
       FROM countries ORDER BY parameter_count DESC, code LIMIT 5""",
)


@query(
    "v_expected_count",
    """SELECT 'countries' AS table_name, count(*) AS total,
              CASE WHEN count(*) = 140 THEN 'pass' WHEN count(*) > 100 THEN 'better' ELSE 'fail' END AS verdict FROM countries
       UNION ALL SELECT 'locations', count(*), CASE WHEN count(*) > 500 THEN 'pass' ELSE 'fail' END FROM locations
       UNION ALL SELECT 'measurements', count(*), CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END FROM measurements""",
)
def _(t: Model) -> DataFrame:
    checks = {
        "countries": quality.expected_countries(t.countries()),
        "locations": quality.expected_locations(t.locations()),
        "measurements": quality.expected_measurements(t.measurements()),
    }
    parts = [df.select(F.lit(n).alias("table_name"), "*") for n, df in checks.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


register(
    "v_country_stats",
    lambda t: quality.v_country_stats(t.countries()),
    "SELECT count(*) AS rows, count(DISTINCT code) AS codes FROM countries WHERE code IS NOT NULL",
)
register(
    "v_top_countries",
    lambda t: quality.v_top_countries(t.locations()),
    """SELECT country_name, count(*) AS locations FROM locations GROUP BY ALL
       ORDER BY 2 DESC, country_name LIMIT 5""",
)
register(
    "v_top_countries_coded",
    lambda t: quality.v_top_countries(t.locations(), 15, with_code=True),
    """SELECT country_code, country_name, count(*) AS locations FROM locations GROUP BY ALL
       ORDER BY 3 DESC, country_code LIMIT 15""",
)
register(
    "v_parameter_list",
    lambda t: quality.v_parameter_list(t.parameters()),
    """SELECT name, display_name, units, count(*) AS uses FROM parameters GROUP BY ALL
       ORDER BY name, display_name, units LIMIT 10""",
)
register(
    "v_temporal_cover",
    lambda t: quality.v_temporal_cover(t.location_spans()),
    "SELECT count(datetime_first) AS with_first, count(datetime_last) AS with_last, count(*) AS total FROM locations",
)
register(
    "v_geo_cover",
    lambda t: quality.v_geo_cover(t.locations()),
    """SELECT count(*) AS with_coordinates, CAST(0 AS BIGINT) AS without_coordinates, count(*) AS total,
              CAST(min(latitude) AS DOUBLE) AS min_latitude, CAST(max(latitude) AS DOUBLE) AS max_latitude,
              CAST(min(longitude) AS DOUBLE) AS min_longitude, CAST(max(longitude) AS DOUBLE) AS max_longitude
       FROM locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
)
register(
    "v_country_locations",
    lambda t: quality.v_country_locations(t.countries(), t.locations()),
    """SELECT c.name, c.code, count(l.location_id) AS locations
       FROM countries c LEFT JOIN locations l ON l.country_code = c.code
       GROUP BY c.name, c.code HAVING count(l.location_id) > 0 ORDER BY 3 DESC, c.code LIMIT 3""",
)
register(
    "v_monitor_types",
    lambda t: quality.v_monitor_types(t.locations()),
    """SELECT is_mobile, is_monitor, count(*) AS locations,
              CASE WHEN is_mobile THEN 'Móvil' ELSE 'Fijo' END AS mobile_label,
              CASE WHEN is_monitor THEN 'Monitor' ELSE 'No Monitor' END AS monitor_label
       FROM locations GROUP BY ALL""",
)
register(
    "v_locations_of",
    lambda t: quality.v_locations_of(t.locations(), "NATION_3"),
    f"""SELECT location_id, name, locality, {_LAT_LON} FROM locations WHERE country_code = 'NATION_3'
        ORDER BY name, location_id LIMIT 10""",
)
register(
    "v_location_loads",
    lambda t: quality.v_location_loads(t.location_spans()),
    """SELECT min(extracted_at) AS first_load, max(extracted_at) AS last_load,
              count(DISTINCT CAST(extracted_at AS DATE)) AS load_days FROM locations""",
)
register(
    "v_sensor_stats",
    lambda t: quality.v_sensor_stats(t.measurements()),
    """SELECT sensor_id, parameter_name, parameter_units, count(*) AS n,
              min(period_from_utc) AS first_period, max(period_from_utc) AS last_period
       FROM measurements GROUP BY ALL""",
)
register(
    "v_parameter_stats",
    lambda t: quality.v_parameter_stats(t.measurements()),
    f"""SELECT parameter_name, parameter_units, count(*) AS n, {_RANGE},
               {mean_sql('value', 2)} AS mean_value, {_SD} FROM measurements GROUP BY ALL""",
)
register(
    "v_daily_counts",
    lambda t: quality.v_daily_counts(t.measurements()),
    "SELECT CAST(period_from_utc AS DATE) AS day, count(*) AS n FROM measurements GROUP BY ALL",
)
register(
    "v_recent10",
    lambda t: quality.v_recent10(t.measurements()),
    """SELECT sensor_id, parameter_name, CAST(value AS DOUBLE) AS value, parameter_units, period_from_utc, period_to_utc
       FROM measurements ORDER BY period_from_utc DESC, sensor_id, parameter_name, value LIMIT 10""",
)
register(
    "v_quality",
    lambda t: quality.v_quality(t.measurements()),
    f"""SELECT count(*) AS total, CAST(0 AS BIGINT) AS null_values, CAST(0 AS BIGINT) AS null_dates,
               count(*) FILTER (has_flags) AS flagged, CAST(0 AS DOUBLE) AS null_values_percent,
               CAST(0 AS DOUBLE) AS null_dates_percent,
               {ratio_sql('(count_if(has_flags) * 100)', 'count(*)', 1)} AS flagged_percent FROM measurements""",
)
register(
    "v_migration",
    lambda t: quality.v_migration(t.countries(), t.station("id", "country_id"), "NATION_7"),
    """SELECT (SELECT count(*) FROM countries) AS countries, (SELECT count(DISTINCT code) FROM countries) AS codes,
              (SELECT count(*) FROM station) AS station_rows, (SELECT count(DISTINCT id) FROM station) AS stations,
              'NATION_7' AS sample_name,
              (SELECT count(*) FROM station WHERE country_id =
                 (SELECT country_id FROM countries WHERE code = 'NATION_7')) AS rows_of_country""",
)
_RANGES = quality.ranges_back(date(2024, 2, 15), (7, 20, 90, 365))
register(
    "v_availability_by_range",
    lambda t: quality.v_availability_by_range(t.measurements(), _RANGES),
    "WITH r(ordinal, range, first_day, last_day) AS (VALUES "
    + ", ".join(f"({i}, '{label}', DATE '{a}', DATE '{b}')" for i, (label, a, b) in enumerate(_RANGES))
    + """), counted AS (
         SELECT ordinal, range, first_day, last_day, count(sensor_id) AS n
         FROM r LEFT JOIN measurements ON CAST(period_from_utc AS DATE) BETWEEN first_day AND last_day GROUP BY ALL)
       SELECT *, ordinal = (SELECT min(ordinal) FROM counted WHERE n > 0) AS is_answer FROM counted""",
)
register(
    "v_total_by_sensor",
    lambda t: quality.v_total_by_sensor(t.measurements(), "sensor_id", (3, 5, 11)),
    "SELECT sensor_id, count(*) AS n FROM measurements WHERE sensor_id IN (3, 5, 11) GROUP BY ALL",
)

register(
    "v_total_of_sensors",
    lambda t: quality.grand_total(quality.v_total_by_sensor(t.measurements(), "sensor_id", (3, 5, 11))),
    "SELECT count(*) AS total FROM measurements WHERE sensor_id IN (3, 5, 11)",
)
