"""Borders and order of the label rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brisa.functions import labels


def labelled(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


@pytest.mark.parametrize(
    "hour, region",
    [
        ("01", "Europa/África"), ("02", "Europa/África"), ("05", "Asia"), ("06", "Asia"),
        ("08", "Oceanía"), ("09", "Oceanía"), ("03", "América/Otros"),
    ],
)
def test_region_by_hour_text(spark, hour, region):
    text = f"2016-01-30T{hour}:00:00Z"
    assert labelled(spark, [(text,)], "x STRING", labels.bucket_region(F.col("x"))) == [region]


def test_region_of_a_timestamp_text_is_other(spark):
    rows = [("2016-01-30 01:00:00",)]
    assert labelled(spark, rows, "x STRING", labels.bucket_region(F.col("x"))) == ["América/Otros"]


def test_sensor_category_takes_the_first_rule(spark):
    rows = [("pm25 no2",), ("NO2",), ("temp",), ("rh",), ("PM10 µg/m³",)]
    assert labelled(spark, rows, "x STRING", labels.bucket_sensor(F.col("x"))) == [
        "Partículas (PM)", "Gases", "Meteorológicos", "Otros", "Partículas (PM)",
    ]


def test_quadrant_borders_belong_to_north_and_east(spark):
    rows = [(-30, -70), (-30, -71), (-31, -70), (-31, -71)]
    column = labels.bucket_quadrant(F.col("a"), F.col("b"))
    assert labelled(spark, rows, "a INT, b INT", column) == [
        "Norte-Este", "Norte-Oeste", "Sur-Este", "Sur-Oeste",
    ]


def test_who_borders_fall_into_the_lower_band(spark):
    rows = [("pm25", 15), ("pm25", 25), ("pm25", 50), ("pm25", 75), ("pm25", 76), ("co", 1), (None, 1)]
    column = labels.band_who(F.col("p"), F.col("v"))
    assert labelled(spark, rows, "p STRING, v INT", column) == [
        "Buena (OMS: ≤15)", "Moderada (OMS: 15-25)", "Dañina para grupos sensibles (25-50)",
        "Dañina para la salud (50-75)", "Muy dañina (>75)", "No evaluado", "No evaluado",
    ]


def test_excess_and_no2_bands_need_more_than_the_limit(spark):
    rows = [(25,), (26,), (50,), (75,), (76,)]
    assert labelled(spark, rows, "v INT", labels.band_pm25_excess(F.col("v"))) == [
        "Aceptable (≤25)", "Moderado (25-50)", "Moderado (25-50)", "Alto (50-75)", "Muy Alto (>75)",
    ]
    assert labelled(spark, [(40,), (41,), (201,)], "v INT", labels.band_no2(F.col("v"))) == [
        "Aceptable (≤40)", "Moderado (40-100)", "Muy Alto (>200)",
    ]


def test_availability_borders_and_unknown_rate(spark):
    rows = [(Decimal("0.80"),), (Decimal("0.60"),), (Decimal("0.40"),), (Decimal("0.39"),), (None,)]
    assert labelled(spark, rows, "v DECIMAL(4,2)", labels.band_availability(F.col("v"))) == [
        "Excelente (≥80%)", "Buena (60-80%)", "Regular (40-60%)", "Deficiente (<40%)", None,
    ]


def test_null_flag_reads_as_false(spark):
    column = labels.bool_label(F.col("x"), labels.MOBILE_LABELS)
    assert labelled(spark, [(True,), (False,), (None,)], "x BOOLEAN", column) == ["Móvil", "Fijo", "Fijo"]
