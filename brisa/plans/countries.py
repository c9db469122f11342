"""Reports on the countries table (one row per country)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions import labels
from brisa.functions.aggregates import agg_count, agg_count_distinct, with_repeated_list
from brisa.functions.scalars import (
    date_of, guarded_div, json_length, julian_days, substr_year, whole_days, year_of,
)
from brisa.operators.filters import (
    filter_cmp, filter_eq, filter_in, filter_json_text, filter_last_24h, filter_null, filter_stale,
    is_today, moment,
)
from brisa.operators.joins import lateral_explode
from brisa.operators.metrics import union_metrics
from brisa.operators.ordering import sort_multi, topk
from brisa.sources.files import write_csv

AsOf = date | datetime | str

# --- fixed values: country code sets of the regional lists, and report labels ---
LATIN_AMERICA = ("AR", "BR", "CL", "CO", "MX", "PE", "UY", "EC", "BO", "PY", "VE")
AMERICA = ("US", "CA", "MX", "BR", "AR", "CL")
EUROPE = ("GB", "FR", "DE", "IT", "ES", "NL", "SE", "NO", "FI", "DK")
ASIA = ("CN", "JP", "KR", "IN", "TH", "VN", "MY", "SG", "ID", "PH")
DUPLICATED_CODES = "Códigos duplicados"
DUPLICATED_IDS = "IDs duplicados"
WITHOUT_CODE = "Registros sin código"
WITHOUT_NAME = "Registros sin nombre"
COVERAGE_LABELS = ("Total países", "Con fecha inicio", "Con fecha última", "Activos hoy")
# ---------------------------------------------------------------------------------


def _now(as_of: AsOf) -> Column:
    return F.lit(str(moment(as_of))).cast("timestamp_ntz")


# The lc_ reports sort NULL as the smallest value, the c_ reports as the largest.
_sorted = partial(sort_multi, nulls_high=False)
_topk = partial(topk, nulls_high=False)


def _parameter_count() -> Column:
    return json_length(F.col("parameters"))


def with_location_counts(c: DataFrame, locations: DataFrame) -> DataFrame:
    """Countries with the number of their locations, for a payload that tells none.

    A country whose row has a count above 0 keeps it. The locations are counted per country before the join.
    """
    counted = locations.groupBy(F.col("country_code").alias("code")).agg(agg_count().alias("_counted"))
    told = F.when(F.col("locations") > 0, F.col("locations"))
    count = F.coalesce(told, F.col("_counted"), F.lit(0)).cast(c.schema["locations"].dataType)
    return c.join(counted, "code", "left").withColumn("locations", count).select(*c.columns)


def c_overview(c: DataFrame) -> DataFrame:
    return c.agg(
        agg_count().alias("countries"),
        agg_count_distinct("code").alias("codes"),
        agg_count_distinct("country_id").alias("ids"),
        F.sum("locations").alias("locations"),
        F.sum("sources").alias("sources"),
        F.min("extracted_at").alias("first_load"),
        F.max("extracted_at").alias("last_load"),
    )


def c_top_locations(c: DataFrame, k: int = 10) -> DataFrame:
    report = filter_cmp(c, locations=0).select(
        "code", "name", "locations", "sources",
        _parameter_count().alias("parameter_count"), "datetimeFirst", "datetimeLast",
    )
    return topk(report, k, "-locations", "code")


def c_top_parameters(c: DataFrame, k: int = 15) -> DataFrame:
    report = c.select(
        "code", "name", _parameter_count().alias("parameter_count"), "parameters", "locations", "sources"
    )
    return topk(report.where("parameter_count > 0"), k, "-parameter_count", "-locations", "code")


def c_most_recent(c: DataFrame, as_of: AsOf, k: int = 10) -> DataFrame:
    report = filter_null(c, not_null=["datetimeLast"]).select(
        "code", "name", "datetimeLast", "locations", "sources",
        whole_days(_now(as_of), F.col("datetimeLast")).alias("days_since"),
    )
    return topk(report, k, "-datetimeLast", "code")


def c_by_region(c: DataFrame) -> DataFrame:
    """Regions are guessed from the raw text of the first date."""
    regions = (
        filter_null(c, not_null=["datetimeFirst_raw"])
        .groupBy(labels.bucket_region(F.col("datetimeFirst_raw")).alias("region"))
        .agg(
            agg_count().alias("countries"),
            F.sum("locations").alias("locations"),
            F.sum("sources").alias("sources"),
        )
    )
    return sort_multi(regions, "-countries", "region")


def c_parameter_usage(c: DataFrame) -> DataFrame:
    """Per parameter: how many countries measure it, their stations and sorted codes."""
    used = lateral_explode(c, "parameters", "parameter")
    report = with_repeated_list(
        used, ["parameter"], "code", "codes", rows_name="countries", sums=["locations"]
    )
    return sort_multi(report, "-countries", "parameter")


def c_stale(c: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    report = filter_cmp(filter_stale(c, "datetimeLast", as_of, days), locations=0).select(
        "code", "name", "locations", "datetimeLast",
        whole_days(_now(as_of), F.col("datetimeLast")).alias("days_inactive"),
    )
    return sort_multi(report, "-days_inactive", "code")


def c_start_year(c: DataFrame) -> DataFrame:
    started = filter_null(c, not_null=["datetimeFirst"]).withColumn(
        "start_year", year_of(F.col("datetimeFirst"))
    )
    report = with_repeated_list(started, ["start_year"], "code", "codes", rows_name="countries")
    return sort_multi(report, "-start_year")


def c_density(c: DataFrame, k: int = 15) -> DataFrame:
    report = filter_cmp(c, locations=0, sources=0).select(
        "code", "name", "locations", "sources",
        guarded_div(F.col("locations"), F.col("sources")).alias("locations_per_source"),
        _parameter_count().alias("parameter_count"),
    )
    return topk(report, k, "-locations_per_source", "code")


def c_latin_america(c: DataFrame, codes: Sequence[str] = LATIN_AMERICA) -> DataFrame:
    report = filter_in(c, "code", codes).select(
        "code", "name", "locations", "sources", "parameters", "datetimeFirst", "datetimeLast"
    )
    return sort_multi(report, "-locations", "code")


def c_load_days(c: DataFrame) -> DataFrame:
    days = c.groupBy(date_of(F.col("extracted_at")).alias("load_day")).agg(
        agg_count().alias("rows"),
        agg_count_distinct("code").alias("codes"),
        F.min("extracted_at").alias("first_load"),
        F.max("extracted_at").alias("last_load"),
    )
    return sort_multi(days, "-load_day")


def c_with_pm(c: DataFrame, names: Sequence[str] = ("pm25", "pm10"), exact: bool = False) -> DataFrame:
    report = filter_json_text(c, "parameters", names, "any", exact).select(
        "code", "name", "locations", "parameters"
    )
    return sort_multi(report, "-locations", "code")


def c_integrity(c: DataFrame) -> DataFrame:
    """Codes and ids that come twice, rows without code, rows without name.

    One grouping per key answers all of it; the rows without a key are its NULL group.
    """
    per_code = c.groupBy("code").agg(agg_count().alias("n"), F.count_if(F.col("name").isNull()).alias("unnamed"))
    per_id = c.groupBy("country_id").agg(agg_count().alias("n"))
    twice = F.col("n") > 1

    def rows(df: DataFrame, found: dict[str, Column]) -> DataFrame:
        counted = {text: F.coalesce(column, F.lit(0)) for text, column in found.items()}
        report = union_metrics(df, counted)
        return report.select(F.col("metric").alias("problem"), F.col("value").alias("found"))

    by_code = rows(
        per_code,
        {
            DUPLICATED_CODES: F.count_if(F.col("code").isNotNull() & twice),
            WITHOUT_CODE: F.sum(F.when(F.col("code").isNull(), F.col("n"))),
            WITHOUT_NAME: F.sum("unnamed"),
        },
    )
    by_id = rows(per_id, {DUPLICATED_IDS: F.count_if(F.col("country_id").isNotNull() & twice)})
    return by_code.unionAll(by_id)


def lc_count(c: DataFrame) -> DataFrame:
    return c.agg(agg_count().alias("countries"))


def lc_list(c: DataFrame) -> DataFrame:
    return _sorted(c.select("code", "name", "datetimeFirst", "datetimeLast"), "name", "code")


def lc_recent10(c: DataFrame, k: int = 10) -> DataFrame:
    dated = filter_null(c, not_null=["datetimeLast"]).select("code", "name", "datetimeLast")
    return _topk(dated, k, "-datetimeLast", "code")


def lc_oldest10(c: DataFrame, k: int = 10) -> DataFrame:
    dated = filter_null(c, not_null=["datetimeFirst"]).select("code", "name", "datetimeFirst")
    return _topk(dated, k, "datetimeFirst", "code")


def lc_param_rich(c: DataFrame, k: int = 15) -> DataFrame:
    report = c.select("code", "name", _parameter_count().alias("parameter_count"), "datetimeFirst")
    return _topk(report.where("parameter_count > 0"), k, "-parameter_count", "code")


def lc_params_of(c: DataFrame, code: str) -> DataFrame:
    return filter_eq(c, "code", code).select("name", "parameters")


def lc_start_year(c: DataFrame) -> DataFrame:
    """By the first four characters of the ISO text."""
    years = (
        filter_null(c, not_null=["datetimeFirst_raw"])
        .groupBy(substr_year(F.col("datetimeFirst_raw")).alias("start_year"))
        .agg(agg_count().alias("countries"))
    )
    return _sorted(years, "start_year")


def lc_duration(c: DataFrame, k: int = 10) -> DataFrame:
    dated = filter_null(c, not_null=["datetimeFirst", "datetimeLast"])
    days = julian_days(F.col("datetimeLast"), F.col("datetimeFirst"))
    return _topk(dated.select("code", "name", days.alias("days_monitored")), k, "-days_monitored", "code")


def lc_codes(c: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Countries of a code set by name; the sets AMERICA, EUROPE and ASIA are given above."""
    return _sorted(filter_in(c, "code", codes).select("code", "name", "datetimeFirst"), "name", "code")


def lc_america(c: DataFrame, codes: Sequence[str] = AMERICA) -> DataFrame:
    return lc_codes(c, codes)


def lc_europe(c: DataFrame, codes: Sequence[str] = EUROPE) -> DataFrame:
    return lc_codes(c, codes)


def lc_asia(c: DataFrame, codes: Sequence[str] = ASIA) -> DataFrame:
    return lc_codes(c, codes)


def lc_coverage(c: DataFrame, as_of: AsOf) -> DataFrame:
    counts = (
        agg_count(),
        F.count("datetimeFirst"),
        F.count("datetimeLast"),
        F.count_if(is_today("datetimeLast", as_of)),
    )
    return union_metrics(c, dict(zip(COVERAGE_LABELS, counts)))


def lc_last24h(c: DataFrame, as_of: AsOf) -> DataFrame:
    recent = filter_last_24h(c, "datetimeLast", as_of).select("code", "name", "datetimeLast")
    return _sorted(recent, "-datetimeLast", "code")


def lc_loads(c: DataFrame) -> DataFrame:
    return c.agg(
        F.min("extracted_at").alias("first_load"),
        F.max("extracted_at").alias("last_load"),
        agg_count().alias("rows"),
    )


def lc_dup_codes(c: DataFrame) -> DataFrame:
    """Codes seen more than once; NULL is a group too."""
    return c.groupBy("code").agg(agg_count().alias("duplicates")).where("duplicates > 1")


def _measuring(c: DataFrame, names: Sequence[str], exact: bool) -> DataFrame:
    return filter_json_text(c, "parameters", names, "all", exact).select("code", "name", "parameters")


def lc_pm25_and_pm10(c: DataFrame, exact: bool = False) -> DataFrame:
    return _measuring(c, ["pm25", "pm10"], exact)


def lc_o3(c: DataFrame, exact: bool = False) -> DataFrame:
    return _measuring(c, ["o3"], exact)


def lc_no2(c: DataFrame, exact: bool = False) -> DataFrame:
    return _measuring(c, ["no2"], exact)


def lc_export(c: DataFrame, path: str) -> str:
    """The whole table as CSV with a header row."""
    write_csv(c, path)
    return path


def summary_report(c: DataFrame, execution_time: str, data_source: str, endpoint: str) -> DataFrame:
    """One-row document: number of countries and the number per estimated region."""
    regions = c_by_region(c).agg(
        F.map_from_entries(F.collect_list(F.struct("region", "countries"))).alias("regional_distribution")
    )
    total = lc_count(c).withColumnRenamed("countries", "total_countries")
    return total.select(
        F.lit(execution_time).alias("execution_time"),
        "total_countries",
        regions.scalar().alias("regional_distribution"),
        F.lit(data_source).alias("data_source"),
        F.lit(endpoint).alias("api_endpoint"),
    )
