"""Reports on the measurement table.

``as_of`` stands for "now"; without it the newest period in the data is taken.
Every aggregate is combined map-side, so one parameter or sensor with a third of
all rows sends one row per task through the shuffle.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions import labels
from brisa.functions.aggregates import agg_avg_round, agg_count, agg_count_distinct, agg_stddev
from brisa.functions.scalars import (
    date_of, epoch_hours, hour_of, percent_over, whole_days, z_score,
)
from brisa.operators.filters import filter_in, filter_recent, latest
from brisa.operators.joins import join_inner_location, join_stats_theta, with_location_name
from brisa.operators.ordering import sort_multi, topk

AsOf = date | datetime | str | None
HOURLY_PARAMETERS = ("pm25", "pm10", "no2", "co", "o3")


def _recent(m: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    ts = "period_from_utc"
    return filter_recent(m, ts, as_of if as_of is not None else latest(m, ts), days)


def _valued(m: DataFrame, parameter: str | None = None) -> DataFrame:
    rows = m.where(F.col("value").isNotNull())
    return rows if parameter is None else rows.where(F.col("parameter_name") == parameter)


def _number_profile(mean: str, digits: int = 2, sd: bool = True) -> list[Column]:
    columns = [
        agg_avg_round("value", digits).alias(mean),
        F.round(F.min("value"), digits).alias("min_value"),
        F.round(F.max("value"), digits).alias("max_value"),
    ]
    if sd:
        columns.append(F.round(agg_stddev("value"), digits).alias("sd_value"))
    return columns


def m_pm25_daily(m: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Mean, count, range and deviation of PM2.5 per day."""
    daily = (
        _recent(_valued(m, "pm25"), as_of, days)
        .groupBy(date_of(F.col("period_from_utc")).alias("day"))
        .agg(agg_count().alias("n"), *_number_profile("mean_pm25"))
    )
    return sort_multi(daily, "-day")


def m_pm25_exceed(m: DataFrame) -> DataFrame:
    """Days whose (rounded) mean of PM2.5 lies above the guideline, worst first."""
    limit = labels.PM25_GUIDELINE
    mean = F.col("mean_pm25")
    daily = (
        _valued(m, "pm25")
        .groupBy(date_of(F.col("period_from_utc")).alias("day"))
        .agg(agg_count().alias("n"), *_number_profile("mean_pm25", sd=False))
    )
    exceeded = daily.where(mean > limit).select(
        "day",
        "mean_pm25",
        (mean - limit).alias("excess"),
        percent_over(mean, limit).alias("excess_percent"),
        "n",
        "min_value",
        "max_value",
        labels.band_pm25_excess(mean).alias("category"),
    )
    return sort_multi(exceeded, "-mean_pm25", "day")


def m_no2_top(
    m: DataFrame, locations: DataFrame, as_of: AsOf = None, days: int = 3, k: int = 1
) -> DataFrame:
    """The k sensors with the highest mean of NO2.

    Measurements are reduced to one row per sensor before the join to locations.
    """
    per_sensor = (
        _recent(_valued(m, "no2"), as_of, days)
        .groupBy("sensor_id", "location_id", "parameter_name", "parameter_units")
        .agg(
            agg_count().alias("n"),
            *_number_profile("mean_no2"),
            F.min("period_from_utc").alias("first_period"),
            F.max("period_from_utc").alias("last_period"),
        )
    )
    report = join_inner_location(per_sensor, locations).select(
        "sensor_id",
        "location_name",
        "mean_no2",
        "parameter_units",
        "n",
        "min_value",
        "max_value",
        "sd_value",
        "first_period",
        "last_period",
        whole_days(F.col("last_period"), F.col("first_period")).alias("days_monitored"),
        labels.band_no2(F.col("mean_no2")).alias("category"),
    )
    return topk(report, k, "-mean_no2", "sensor_id")


def m_weekly_summary(m: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Per parameter and unit, in the fixed order of the parameters."""
    summary = (
        _recent(_valued(m), as_of, days)
        .groupBy("parameter_name", "parameter_units")
        .agg(
            agg_count().alias("n"),
            *_number_profile("mean_value"),
            agg_count_distinct("sensor_id").alias("active_sensors"),
            F.min("period_from_utc").alias("first_period"),
            F.max("period_from_utc").alias("last_period"),
        )
    )
    return sort_multi(
        summary,
        labels.parameter_rank(F.col("parameter_name")),
        "parameter_name",
        "parameter_units",
    )


def m_hourly_profile(m: DataFrame, parameters=HOURLY_PARAMETERS) -> DataFrame:
    profile = (
        filter_in(_valued(m), "parameter_name", parameters)
        .groupBy(hour_of(F.col("period_from_utc")).alias("hour_utc"), "parameter_name")
        .agg(agg_count().alias("n"), *_number_profile("mean_value", sd=False))
    )
    return sort_multi(profile, "parameter_name", "hour_utc")


def m_who_daily(m: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Daily mean per parameter with its rating by the WHO limits."""
    daily = (
        _recent(_valued(m), as_of, days)
        .groupBy(date_of(F.col("period_from_utc")).alias("day"), "parameter_name")
        .agg(agg_avg_round("value", 2).alias("mean_value"), agg_count().alias("n"))
    )
    rated = daily.withColumn(
        "who_rating", labels.band_who(F.col("parameter_name"), F.col("mean_value"))
    )
    return sort_multi(rated, "-day", "parameter_name")


def parameter_statistics(m: DataFrame) -> DataFrame:
    """Mean and deviation of each parameter over the WHOLE history."""
    return _valued(m).groupBy("parameter_name").agg(
        F.avg("value").alias("mean_all"), agg_stddev("value").alias("sd_all")
    )


def m_spikes(
    m: DataFrame, as_of: AsOf = None, days: int = 7, k: int = 20, history: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Recent values more than two deviations above the mean of all history.

    ``history`` is where the statistics are taken from, by default ``m``; the time
    filter applies to the tested rows only. ``stats`` are these statistics from a stored summary
    (``summaries.summary_statistics``); then only the recent rows are read.
    """
    if stats is None:
        stats = parameter_statistics(m if history is None else history)
    value, mean, sd = F.col("value"), F.col("mean_all"), F.col("sd_all")
    recent = _recent(m, as_of, days).select(
        "sensor_id", "parameter_name", "period_from_utc", "value"
    )
    spikes = join_stats_theta(
        recent, stats, "parameter_name", value.cast("double") > mean.cast("double") + 2 * sd
    ).select(
        "sensor_id",
        "parameter_name",
        "period_from_utc",
        F.round(value, 2).alias("measured"),
        F.round(mean, 2).alias("mean_all"),
        F.round(value - mean, 2).alias("difference"),
        F.round(z_score(value, mean, sd), 2).alias("deviations"),
    )
    return topk(spikes, k, "-deviations")


def m_availability(m: DataFrame, locations: DataFrame) -> DataFrame:
    """Per sensor: measurements per hour of its observed span, with a label.

    A sensor with one measurement has no span; its rate and label are NULL.
    """
    per_sensor = (
        _valued(m)
        .groupBy("sensor_id", "parameter_name", "location_id")
        .agg(
            agg_count().alias("n"),
            F.min("period_from_utc").alias("first_period"),
            F.max("period_from_utc").alias("last_period"),
        )
        .withColumn("hours", epoch_hours(F.col("last_period"), F.col("first_period")))
        .withColumn("rate", F.try_divide(F.col("n").cast("decimal(18,0)"), F.col("hours")))
    )
    report = with_location_name(per_sensor, locations).select(
        "sensor_id",
        "parameter_name",
        "location_name",
        "n",
        "first_period",
        "last_period",
        "hours",
        F.round("rate", 2).alias("per_hour"),
        labels.band_availability(F.col("rate")).alias("data_quality"),
    )
    return sort_multi(report, "-per_hour", "sensor_id", "parameter_name")
