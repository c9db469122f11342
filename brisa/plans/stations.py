"""Reports on the station table: one row per station and sensor.

Most reports also take combined rows (``aggregates.combined_rows``), which stand for many: a report on places then joins
its dimensions to one row per station, not to every row.

Listings end their sort with the table's key (id, sensor_id). It makes the order
repeatable, and it lets the range partitioning split a station or a place that
holds a large share of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions import labels
from brisa.functions.aggregates import (
    agg_avg_rows, agg_count, agg_count_col, agg_count_distinct, agg_rows, string_list, with_distinct_list, with_repeated_list,
)
from brisa.functions.scalars import concat_key, date_of
from brisa.operators.filters import filter_eq, filter_in, filter_like_ci, filter_null, like_any
from brisa.operators.joins import join_inner_country, join_left_agg
from brisa.operators.metrics import union_checks, union_metrics
from brisa.operators.ordering import sort_multi, topk
from brisa.session import as_written_table

# --- fixed values: sensor names, places and report labels ---------------------
PM_SENSORS = ("pm25 µg/m³", "pm10 µg/m³")
GAS_SENSORS = ("no2 µg/m³", "so2 µg/m³", "o3 µg/m³")
MAIN_CITIES = ("Santiago", "Valparaíso", "Concepción", "La Serena", "Antofagasta")
METRO_PLACES = ("%Santiago%", "%Las Condes%", "%Providencia%", "%Maipú%")
PM25_PATTERNS = ("%pm2.5%", "%pm25%")
WITHOUT_STATION_ID = "Registros sin ID de estación"
WITHOUT_SENSOR_ID = "Registros sin ID de sensor"
WITHOUT_STATION_NAME = "Registros sin nombre de estación"
WITHOUT_COORDINATES = "Registros sin coordenadas"
WITHOUT_PROVIDER = "Registros sin proveedor"
REPORT_LABELS = (
    "Total registros", "Estaciones únicas", "Tipos de sensores", "Localidades", "Proveedores",
)
# ------------------------------------------------------------------------------

KEY = ("id", "sensor_id")
_HAS_POSITION = ["latitude", "longitude"]


def _stations() -> Column:
    return agg_count_distinct("id")


# The ls_ reports sort NULL as the smallest value, the s_ reports as the largest.
_sorted = partial(sort_multi, nulls_high=False)
_topk = partial(topk, nulls_high=False)


def _listing(
    st: DataFrame, columns: Sequence[str], *order: str, nulls_high: bool = True
) -> DataFrame:
    ties = [k for k in KEY if k not in order]
    return sort_multi(st, *order, *ties, nulls_high=nulls_high).select(*columns)


_low_listing = partial(_listing, nulls_high=False)


def s_overview(st: DataFrame) -> DataFrame:
    last = "last_extracted_at" if "last_extracted_at" in st.columns else "extracted_at"
    return st.agg(
        agg_rows(st).alias("rows"),
        _stations().alias("stations"),
        agg_count_distinct("sensor_id").alias("sensors"),
        agg_count_distinct("provider_id").alias("providers"),
        agg_count_distinct("locality").alias("localities"),
        F.min("extracted_at").alias("first_load"),
        F.max(last).alias("last_load"),
    )


def s_top_sensors(st: DataFrame, k: int = 15) -> DataFrame:
    """Stations with the most sensors, with their sorted distinct sensor names.

    The k stations are found by counts alone; names are listed for these only.
    """
    keys = ["id", "name", "locality", "provider_name"]
    counts = st.groupBy(*keys).agg(agg_count_distinct("sensor_id").alias("sensors"))
    top = as_written_table(topk(counts, k, "-sensors", *keys), "top-stations")
    # k ids, known as a value: the filter goes below the joins that gave the rows their dimensions
    ids = top.agg(F.collect_set("id")).scalar()
    st = st.where(F.col("id").isNull() | F.array_contains(ids, F.col("id")))
    renamed = top.select(*[F.col(c).alias(f"_{c}") for c in top.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    chosen = st.join(renamed, same).select(*keys, "sensor_name", F.col("_sensors").alias("sensors"))
    report = with_distinct_list(chosen, [*keys, "sensors"], "sensor_name", "sensor_names")
    return sort_multi(report, "-sensors", *keys)


def s_by_provider(st: DataFrame) -> DataFrame:
    report = filter_null(st, not_null=["provider_name"]).groupBy("provider_name", "provider_id").agg(
        _stations().alias("stations"),
        agg_rows(st).alias("rows"),
        agg_count_distinct("sensor_name").alias("sensor_names"),
    )
    return sort_multi(report, "-stations", "provider_name", "provider_id")


def s_sensor_types(st: DataFrame) -> DataFrame:
    report = filter_null(st, not_null=["sensor_name"]).groupBy("sensor_name").agg(
        agg_rows(st).alias("rows"),
        _stations().alias("stations"),
        agg_count_distinct("provider_id").alias("providers"),
    )
    return sort_multi(report, "-rows", "sensor_name")


def s_by_locality(st: DataFrame) -> DataFrame:
    report = filter_null(st, not_null=["locality"]).groupBy("locality").agg(
        _stations().alias("stations"),
        agg_rows(st).alias("rows"),
        agg_count_distinct("provider_name").alias("providers"),
        agg_avg_rows(st, "latitude", 6).alias("mean_latitude"),
        agg_avg_rows(st, "longitude", 6).alias("mean_longitude"),
    )
    return sort_multi(report, "-stations", "locality")


def s_with_coords(st: DataFrame) -> DataFrame:
    """Stations with a position, with the count and list of their sensors, repeats included."""
    keys = ["id", "name", "locality", "latitude", "longitude", "provider_name"]
    report = with_repeated_list(
        filter_null(st, not_null=_HAS_POSITION), keys, "sensor_name", "sensor_names", rows_name="sensors"
    )
    return sort_multi(report, "locality", "name", "id", "provider_name")


def s_mobile_monitor(st: DataFrame) -> DataFrame:
    report = st.groupBy("is_mobile", "is_monitor").agg(
        _stations().alias("stations"),
        agg_rows(st).alias("rows"),
        agg_count_distinct("sensor_name").alias("sensor_names"),
    )
    return sort_multi(report, "is_mobile", "is_monitor")


def _by_place(st: DataFrame, group: str) -> DataFrame:
    """Stations, rows and sorted distinct localities per group.

    Rows are reduced to one per (group, station, locality) first.
    """
    reduced = st.groupBy(group, "id", "locality").agg(agg_rows(st).alias("_n"))
    return reduced.groupBy(group).agg(
        _stations().alias("stations"),
        F.sum("_n").alias("rows"),
        string_list("locality").alias("localities"),
    )


def s_by_timezone(st: DataFrame) -> DataFrame:
    report = _by_place(filter_null(st, not_null=["timezone"]), "timezone")
    return sort_multi(report, "-stations", "timezone")


def s_detail(st: DataFrame, station_id: int) -> DataFrame:
    columns = [
        "id", "name", "locality", "latitude", "longitude", "timezone", "provider_name",
        "sensor_id", "sensor_name", "is_mobile", "is_monitor", "extracted_at",
    ]
    return _listing(filter_eq(st, "id", station_id), columns, "sensor_name")


def s_search_locality(st: DataFrame, pattern: str) -> DataFrame:
    keys = ["id", "name", "locality", "provider_name", "latitude", "longitude"]
    report = with_repeated_list(
        filter_like_ci(st, "locality", pattern), keys, "sensor_name", "sensor_names", rows_name="sensors"
    )
    return sort_multi(report, "name", "id", "provider_name")


def s_by_country(st: DataFrame, c: DataFrame) -> DataFrame:
    """Rows are reduced to one per (country, station, provider) before the join."""
    reduced = st.groupBy("country_id", "id", "provider_name").agg(agg_rows(st).alias("_n"))
    report = join_inner_country(c, reduced).groupBy("country_code", "country_name").agg(
        _stations().alias("stations"),
        F.sum(F.when(F.col("id").isNotNull(), F.col("_n")).otherwise(0)).alias("rows"),
        agg_count_distinct("provider_name").alias("providers"),
    )
    return sort_multi(report, "-stations", "country_code")


def s_variety(st: DataFrame, k: int = 20) -> DataFrame:
    """Distinct sensor names per sensor, for stations with more than one sensor."""
    ratio = F.try_divide(F.col("variety").cast("decimal(18,0)"), F.col("sensors").cast("decimal(18,0)"))
    report = (
        st.groupBy("id", "name", "locality", "provider_name")
        .agg(agg_count_distinct("sensor_name").alias("variety"), agg_rows(st, F.col("sensor_id").isNotNull()).alias("sensors"))
        .where("sensors > 1")
        .withColumn("variety_ratio", F.round(ratio, 2))
    )
    return topk(report, k, "-variety", "-sensors", "id", "name", "locality", "provider_name")


def s_load_days(st: DataFrame) -> DataFrame:
    report = st.groupBy(date_of(F.col("extracted_at")).alias("load_day")).agg(
        agg_count().alias("rows"),
        _stations().alias("stations"),
        agg_count_distinct("sensor_id").alias("sensors"),
        F.min("extracted_at").alias("first_load"),
        F.max("extracted_at").alias("last_load"),
    )
    return sort_multi(report, "-load_day")


def s_search_sensor(st: DataFrame, patterns: Sequence[str] = PM25_PATTERNS) -> DataFrame:
    columns = [
        "id", "name", "locality", "latitude", "longitude", "provider_name", "sensor_name", "sensor_id",
    ]
    return _listing(filter_like_ci(st, "sensor_name", *patterns), columns, "locality", "name")


def s_integrity(st: DataFrame) -> DataFrame:
    return union_checks(
        st,
        {
            WITHOUT_STATION_ID: F.col("id").isNull(),
            WITHOUT_SENSOR_ID: F.col("sensor_id").isNull(),
            WITHOUT_STATION_NAME: F.col("name").isNull(),
            WITHOUT_COORDINATES: F.col("latitude").isNull() | F.col("longitude").isNull(),
            WITHOUT_PROVIDER: F.col("provider_name").isNull(),
        },
    )


def _bounding_box(st: DataFrame) -> DataFrame:
    return filter_null(st, not_null=_HAS_POSITION).agg(
        F.min("latitude").alias("min_latitude"),
        F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"),
        F.max("longitude").alias("max_longitude"),
        _stations().alias("stations"),
    )


def s_bbox_density(st: DataFrame) -> DataFrame:
    """Area of the bounding box in square degrees, and stations per square degree."""
    area = (F.col("max_latitude") - F.col("min_latitude")) * (
        F.col("max_longitude") - F.col("min_longitude")
    )
    density = F.try_divide(F.col("stations").cast("decimal(18,0)"), area)
    return _bounding_box(st).select(
        "*", F.round(area, 4).alias("area"), F.round(density, 2).alias("density")
    )


def s_quadrants(st: DataFrame) -> DataFrame:
    quadrant = labels.bucket_quadrant(F.col("latitude"), F.col("longitude"))
    placed = filter_null(st, not_null=_HAS_POSITION).withColumn("quadrant", quadrant)
    return sort_multi(_by_place(placed, "quadrant").drop("rows"), "-stations", "quadrant")


def ls_count(st: DataFrame) -> DataFrame:
    return st.agg(agg_count().alias("rows"))


def ls_count_stations(st: DataFrame) -> DataFrame:
    return st.agg(_stations().alias("stations"))


def ls_list(st: DataFrame) -> DataFrame:
    columns = ["id", "name", "locality", "sensor_name", "provider_name"]
    return _low_listing(st, columns, "name", "sensor_name")


def ls_unique(st: DataFrame) -> DataFrame:
    columns = ["id", "name", "locality", "provider_name", "latitude", "longitude"]
    return _sorted(st.select(*columns).distinct(), "name", *[c for c in columns if c != "name"])


def ls_by_provider(st: DataFrame) -> DataFrame:
    """Rows without a provider form a group of their own."""
    report = st.groupBy("provider_name").agg(agg_rows(st).alias("rows"), _stations().alias("stations"))
    return _sorted(report, "-rows", "provider_name")


def ls_sensor_types(st: DataFrame) -> DataFrame:
    report = filter_null(st, not_null=["sensor_name"]).groupBy("sensor_name")
    return _sorted(report.agg(agg_rows(st).alias("rows")), "-rows", "sensor_name")


def ls_top_sensors(st: DataFrame, k: int = 15) -> DataFrame:
    report = st.groupBy("id", "name", "locality").agg(agg_rows(st).alias("rows"))
    return _topk(report, k, "-rows", "id")


def ls_with_sensor(st: DataFrame, pattern: str = "%pm25%") -> DataFrame:
    columns = ["name", "locality", "provider_name"]
    found = filter_like_ci(st, "sensor_name", pattern).select(*columns).distinct()
    return _sorted(found, *columns)


def ls_by_locality(st: DataFrame) -> DataFrame:
    report = filter_null(st, not_null=["locality"]).groupBy("locality")
    return _sorted(report.agg(_stations().alias("stations")), "-stations", "locality")


def ls_in_city(st: DataFrame, pattern: str = "%Santiago%") -> DataFrame:
    columns = ["name", "sensor_name", "latitude", "longitude"]
    return _low_listing(filter_like_ci(st, "locality", pattern), columns, "name", "sensor_name")


def ls_bbox(st: DataFrame) -> DataFrame:
    return _bounding_box(st)


def ls_country_counts(c: DataFrame, st: DataFrame) -> DataFrame:
    report = join_left_agg(
        c, st, "country_id", "country_id", ["name", "code"], "id", "rows", "stations"
    )
    return _sorted(report, "-rows", "code")


def ls_country_detail(c: DataFrame, st: DataFrame, code: str = "CL", k: int = 20) -> DataFrame:
    report = join_inner_country(filter_eq(c, "code", code), st).select(
        "country_name", "country_code", F.col("name").alias("station_name"), "locality", "sensor_name"
    )
    return _topk(report, k, "station_name", "sensor_name")


def ls_key_check(st: DataFrame) -> DataFrame:
    """Rows against distinct composite keys; a key with a NULL part is not counted."""
    return st.agg(
        agg_count().alias("rows"),
        agg_count_distinct(concat_key(F.col("id"), F.col("sensor_id"))).alias("keys"),
    )


def ls_dup_keys(st: DataFrame) -> DataFrame:
    return st.groupBy("id", "sensor_id").agg(agg_count().alias("duplicates")).where("duplicates > 1")


def ls_dup_sensor_type(st: DataFrame) -> DataFrame:
    grouped = st.groupBy("id", "name", "sensor_name")
    return grouped.agg(agg_count().alias("rows")).where("rows > 1")


def ls_main_cities(st: DataFrame, cities: Sequence[str] = MAIN_CITIES) -> DataFrame:
    columns = ["locality", "name", "sensor_name", "provider_name"]
    return _low_listing(filter_in(st, "locality", cities), columns, "locality", "name")


def ls_metro(st: DataFrame, patterns: Sequence[str] = METRO_PLACES) -> DataFrame:
    columns = ["name", "locality", "sensor_name", "latitude", "longitude"]
    return _low_listing(st.where(like_any(["locality"], patterns)), columns, "locality", "name")


def ls_pm(st: DataFrame, names: Sequence[str] = PM_SENSORS) -> DataFrame:
    found = filter_in(st, "sensor_name", names).select("name", "locality", "provider_name")
    return _sorted(found.distinct(), "locality", "name", "provider_name")


def ls_gases(st: DataFrame, names: Sequence[str] = GAS_SENSORS) -> DataFrame:
    found = filter_in(st, "sensor_name", names).select("name", "locality", "sensor_name")
    return _sorted(found.distinct(), "locality", "name", "sensor_name")


def ls_complete(st: DataFrame, at_least: int = 3) -> DataFrame:
    """Stations with at least so many sensor types, with their list (comma, by value)."""
    keys = ["id", "name", "locality"]
    listed = with_distinct_list(st, keys, "sensor_name", "sensor_names", "sensor_types", ",")
    report = listed.where(F.col("sensor_types") >= at_least)
    return _sorted(report, "-sensor_types", "name", "id")


def ls_report(st: DataFrame) -> DataFrame:
    counts = (
        agg_rows(st),
        _stations(),
        agg_count_distinct("sensor_name"),
        agg_count_distinct("locality"),
        agg_count_distinct("provider_name"),
    )
    return union_metrics(st, dict(zip(REPORT_LABELS, counts)))


def ls_sensor_category(st: DataFrame) -> DataFrame:
    category = labels.bucket_sensor(F.col("sensor_name")).alias("category")
    report = filter_null(st, not_null=["sensor_name"]).groupBy(category)
    return _sorted(report.agg(agg_rows(st).alias("rows")), "-rows", "category")


def ls_top10(st: DataFrame, k: int = 10) -> DataFrame:
    report = st.groupBy("name", "locality", "provider_name").agg(agg_rows(st).alias("rows"))
    return _topk(report, k, "-rows", "name", "locality", "provider_name")


def ls_by_city(st: DataFrame) -> DataFrame:
    report = filter_null(st, not_null=["locality"]).groupBy("locality").agg(
        _stations().alias("stations"), agg_rows(st).alias("rows")
    )
    return _sorted(report, "-rows", "locality")
