"""Checks on the loaded tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.functions import labels
from brisa.functions.aggregates import agg_conditional, agg_count, agg_count_distinct, agg_stddev
from brisa.functions.scalars import date_of, duration, json_length, percent_of, year_of
from brisa.operators.filters import filter_eq, filter_in, filter_like_lower, filter_null
from brisa.operators.flatten import explode_sensors
from brisa.operators.joins import join_left_agg, scalar_subquery
from brisa.operators.ordering import sort_multi, topk
from brisa.session import as_written_table

# --- fixed values ---------------------------------------------------------------
# countries to ask for while the countries table is empty, or cannot be read
DEFAULT_CODES = ("CL", "AR", "BR", "CO", "PE", "US", "DE", "CN", "IN", "GB")
FALLBACK_CODES = ("CL", "AR", "BR", "CO", "PE")
EXPECTED_COUNTRIES = 140
BETTER_COUNTRIES = 100
EXPECTED_LOCATIONS = 500
# --------------------------------------------------------------------------------


class EmptyTable(ValueError):
    """A table that must hold rows has none."""


def table_totals(**distinct: tuple[DataFrame, str]) -> DataFrame:
    """Per table its rows and the distinct values of one column."""
    report = None
    for name, (df, col) in distinct.items():
        row = df.agg(agg_count().alias("rows"), agg_count_distinct(col).alias("distinct_values"))
        row = row.select(F.lit(name).alias("table_name"), "rows", "distinct_values")
        report = row if report is None else report.unionAll(row)
    return report


def v_validate(countries: DataFrame, locations: DataFrame, parameters: DataFrame) -> DataFrame:
    """Rows and distinct keys per table; fails if any of the tables is empty.

    The report has one row per table, so that reading it here costs one small job.
    """
    report = table_totals(
        countries=(countries, "code"),
        locations=(locations, "country_code"),
        parameters=(parameters, "name"),
    )
    return fail_if_empty(report)


def fail_if_empty(report: DataFrame) -> DataFrame:
    """Puts the gate into the plan: the query fails when a table counts 0 rows."""
    empty = F.raise_error(F.concat(F.lit("table is empty: "), F.col("table_name"))).cast("bigint")
    return report.withColumn("rows", F.when(F.col("rows") == 0, empty).otherwise(F.col("rows")))


def v_validate_posts(posts: DataFrame) -> DataFrame:
    stats = posts.agg(
        agg_count().alias("rows"),
        agg_count_distinct("user_id").alias("users"),
        F.min("extracted_at").alias("first_load"),
        F.max("extracted_at").alias("last_load"),
    )
    checked = fail_if_empty(stats.withColumn("table_name", F.lit("api_posts")))
    return checked.drop("table_name")


def v_iso_codes(countries: DataFrame, defaults: Sequence[str] = DEFAULT_CODES) -> DataFrame:
    """Distinct codes in order; the default list if the table has none."""
    spark = countries.sparkSession
    known = filter_null(countries, not_null=["code"]).select("code").distinct()
    backup = spark.createDataFrame([(c,) for c in defaults], "code STRING")
    unused = known.agg((F.count(F.lit(1)) == 0).alias("none")).scalar()
    return sort_multi(known.unionAll(backup.where(unused)), "code")


def iso_codes_to_ask(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    """Codes of the countries table that ``read`` opens; a short list if it cannot be read.

    The distinct codes are written at once, so that a file which fails while it is read counts as unreadable too.
    """
    try:
        return v_iso_codes(as_written_table(read().select("code").distinct(), "codes"))
    except (PySparkException, Py4JJavaError):  # the second if it is a task that fails
        return spark.createDataFrame([(c,) for c in FALLBACK_CODES], "code STRING")


def v_locality_sensors(
    locations: DataFrame, country_code: str, pattern: str, columns: Sequence[str] = ("locality",)
) -> DataFrame:
    """Sensors of the locations of one country whose place matches a lower-case pattern."""
    chosen = filter_like_lower(filter_eq(locations, "country_code", country_code), columns, pattern)
    return explode_sensors(chosen)


def v_sensor_counts(m: DataFrame) -> DataFrame:
    counts = m.groupBy("sensor_id", "parameter_name").agg(agg_count().alias("n"))
    return sort_multi(counts, "-n", "sensor_id", "parameter_name")


def v_country_sample(c: DataFrame, k: int = 10) -> DataFrame:
    columns = ["country_id", "code", "name", "datetimeFirst", "datetimeLast"]
    return topk(c.select(*columns), k, "name", "country_id")


def v_country_dups(c: DataFrame) -> DataFrame:
    counts = c.groupBy("code").agg(agg_count().alias("n")).where("n > 1")
    return sort_multi(counts, "-n", "code")


def v_country_duration(c: DataFrame, k: int = 5) -> DataFrame:
    first, last = F.col("datetimeFirst"), F.col("datetimeLast")
    report = filter_null(c, not_null=["datetimeFirst", "datetimeLast"]).select(
        "code",
        "name",
        year_of(first).alias("first_year"),
        year_of(last).alias("last_year"),
        duration(last, first).alias("duration"),
    )
    return topk(report, k, "-duration", "code")


def v_country_params(c: DataFrame, k: int = 5) -> DataFrame:
    report = filter_null(c, not_null=["parameters"]).select(
        "code", "name", json_length(F.col("parameters")).alias("parameter_count")
    )
    return topk(report, k, "-parameter_count", "code")


def v_expected_count(df: DataFrame, rules: Sequence[tuple[str, int, str]], otherwise: str = "fail") -> DataFrame:
    """Total against expectations; rules are (operator, number, verdict), the first that holds wins."""
    tests = {"=": lambda n, x: n == x, ">": lambda n, x: n > x}
    total = F.col("total")
    verdict = labels.case_label([(tests[op](total, n), text) for op, n, text in rules], otherwise)
    return df.agg(agg_count().alias("total")).select("total", verdict.alias("verdict"))


def expected_countries(c: DataFrame) -> DataFrame:
    return v_expected_count(c, [("=", EXPECTED_COUNTRIES, "pass"), (">", BETTER_COUNTRIES, "better")])


def expected_locations(locations: DataFrame) -> DataFrame:
    return v_expected_count(locations, [(">", EXPECTED_LOCATIONS, "pass")])


def expected_measurements(m: DataFrame) -> DataFrame:
    return v_expected_count(m, [(">", 0, "pass")])


def v_country_stats(c: DataFrame) -> DataFrame:
    coded = filter_null(c, not_null=["code"])
    return coded.agg(agg_count().alias("rows"), agg_count_distinct("code").alias("codes"))


def v_top_countries(locations: DataFrame, k: int = 5, with_code: bool = False) -> DataFrame:
    group = ["country_code", "country_name"] if with_code else ["country_name"]
    named = filter_null(locations, not_null=group[:1])
    return topk(named.groupBy(*group).agg(agg_count().alias("locations")), k, "-locations", *group)


def v_parameter_list(parameters: DataFrame, k: int = 10) -> DataFrame:
    uses = filter_null(parameters, not_null=["name"]).groupBy("name", "display_name", "units")
    return topk(uses.agg(agg_count().alias("uses")), k, "name", "display_name", "units")


def v_temporal_cover(locations: DataFrame) -> DataFrame:
    return locations.agg(
        agg_conditional(F.col("datetime_first").isNotNull()).alias("with_first"),
        agg_conditional(F.col("datetime_last").isNotNull()).alias("with_last"),
        agg_count().alias("total"),
    )


def v_geo_cover(locations: DataFrame) -> DataFrame:
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return locations.agg(
        agg_conditional(placed).alias("with_coordinates"),
        agg_conditional(~placed).alias("without_coordinates"),
        agg_count().alias("total"),
        F.min("latitude").alias("min_latitude"),
        F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"),
        F.max("longitude").alias("max_longitude"),
    )


def v_country_locations(c: DataFrame, locations: DataFrame, k: int = 3) -> DataFrame:
    counts = join_left_agg(
        c, locations, "code", "country_code", ["name", "code"], "location_id", "locations"
    )
    return topk(counts, k, "-locations", "code")


def v_monitor_types(locations: DataFrame) -> DataFrame:
    counts = locations.groupBy("is_mobile", "is_monitor").agg(agg_count().alias("locations"))
    labelled = counts.select(
        "*",
        labels.bool_label(F.col("is_mobile"), labels.MOBILE_LABELS).alias("mobile_label"),
        labels.bool_label(F.col("is_monitor"), labels.MONITOR_LABELS).alias("monitor_label"),
    )
    return sort_multi(labelled, "-locations", "is_mobile", "is_monitor")


def v_locations_of(locations: DataFrame, country_code: str = "CL", k: int = 10) -> DataFrame:
    columns = ["location_id", "name", "locality", "latitude", "longitude"]
    return topk(filter_eq(locations, "country_code", country_code).select(*columns), k, "name", "location_id")


def v_location_loads(locations: DataFrame) -> DataFrame:
    return locations.agg(
        F.min("extracted_at").alias("first_load"),
        F.max("extracted_at").alias("last_load"),
        agg_count_distinct(date_of(F.col("extracted_at"))).alias("load_days"),
    )


def v_sensor_stats(m: DataFrame) -> DataFrame:
    stats = m.groupBy("sensor_id", "parameter_name", "parameter_units").agg(
        agg_count().alias("n"),
        F.min("period_from_utc").alias("first_period"),
        F.max("period_from_utc").alias("last_period"),
    )
    return sort_multi(stats, "-n", "sensor_id", "parameter_name", "parameter_units")


def v_parameter_stats(m: DataFrame) -> DataFrame:
    """Range, mean and deviation per parameter, rounded to two digits as they are shown."""
    stats = filter_null(m, not_null=["value"]).groupBy("parameter_name", "parameter_units").agg(
        agg_count().alias("n"),
        F.round(F.min("value"), 2).alias("min_value"),
        F.round(F.max("value"), 2).alias("max_value"),
        F.round(F.avg("value"), 2).alias("mean_value"),
        F.round(agg_stddev("value"), 2).alias("sd_value"),
    )
    return sort_multi(stats, "parameter_name", "parameter_units")


def v_daily_counts(m: DataFrame) -> DataFrame:
    counts = m.groupBy(date_of(F.col("period_from_utc")).alias("day")).agg(agg_count().alias("n"))
    return sort_multi(counts, "day")


def v_recent10(m: DataFrame, k: int = 10) -> DataFrame:
    columns = [
        "sensor_id", "parameter_name", "value", "parameter_units", "period_from_utc", "period_to_utc",
    ]
    return topk(m.select(*columns), k, "-period_from_utc", "sensor_id")


def v_quality(m: DataFrame) -> DataFrame:
    """Null values, null dates and flagged rows, as count and percent."""
    counts = m.agg(
        agg_count().alias("total"),
        agg_conditional(F.col("value").isNull()).alias("null_values"),
        agg_conditional(F.col("period_from_utc").isNull()).alias("null_dates"),
        agg_conditional(F.col("has_flags")).alias("flagged"),
    )
    shares = [
        percent_of(F.col(c), F.col("total")).alias(f"{c}_percent")
        for c in ("null_values", "null_dates", "flagged")
    ]
    return counts.select("*", *shares)


def v_migration(c: DataFrame, st: DataFrame, code: str = "CL") -> DataFrame:
    """Counts after a copy, one sample country, and the station rows of that country."""
    countries = c.agg(agg_count().alias("countries"), agg_count_distinct("code").alias("codes"))
    stations = st.agg(agg_count().alias("station_rows"), agg_count_distinct("id").alias("stations"))
    chosen = filter_eq(c, "code", code)
    of_country = scalar_subquery(st, "country_id", chosen, "country_id").agg(agg_count().alias("n"))
    sample = chosen.select("name").limit(1)
    return countries.select(
        "countries",
        "codes",
        stations.select("station_rows").scalar().alias("station_rows"),
        stations.select("stations").scalar().alias("stations"),
        sample.scalar().alias("sample_name"),
        of_country.scalar().alias("rows_of_country"),
    )


def v_total_by_sensor(m: DataFrame, key: str, values: Sequence[object]) -> DataFrame:
    """Records per chosen sensor (or country)."""
    counts = filter_in(m, key, values).groupBy(key).agg(agg_count().alias("n"))
    return sort_multi(counts, key)


def grand_total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


def ranges_back(as_of: date | datetime, days: Sequence[int]) -> list[tuple[str, date, date]]:
    """Candidate ranges of N days back from ``as_of``, as (label, first, last) dates."""
    today = as_of.date() if isinstance(as_of, datetime) else as_of
    return [
        (f"last {n} days", date.fromordinal(today.toordinal() - n), today) for n in days
    ]


def v_availability_by_range(
    m: DataFrame, ranges: Sequence[tuple[str, date, date]], ts: str = "period_from_utc"
) -> DataFrame:
    """Measurements in each candidate range, and which one is the first with any.

    All ranges are counted in one pass; their outer bounds go to the scan.
    """
    day = F.to_date(ts)

    def inside(first: date, last: date) -> Column:
        return day.between(F.lit(first), F.lit(last))

    lowest = min(first for _, first, _ in ranges)
    counts = m.where(F.col(ts) >= F.lit(str(lowest)).cast("timestamp_ntz")).agg(
        *[F.count_if(inside(a, b)).alias(f"_r{i}") for i, (_, a, b) in enumerate(ranges)]
    )
    first_with_any = F.coalesce(
        *[F.when(F.col(f"_r{i}") > 0, F.lit(i)) for i in range(len(ranges))]
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(label).alias("range"), F.lit(a).alias("first_day"),
            F.lit(b).alias("last_day"), F.col(f"_r{i}").alias("n"),
            F.coalesce(first_with_any == i, F.lit(False)).alias("is_answer"),
        )
        for i, (label, a, b) in enumerate(ranges)
    ])
    return counts.select(F.inline(rows))
