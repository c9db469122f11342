"""Label rules: the first condition that holds gives the label.

The label texts and limits are fixed values that reports are compared by.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
PM25_GUIDELINE = 25
# (lower limit, label): the value must be above the limit
PM25_EXCESS_BANDS = [
    (75, "Muy Alto (>75)"),
    (50, "Alto (50-75)"),
    (25, "Moderado (25-50)"),
]
PM25_EXCESS_ELSE = "Aceptable (≤25)"
NO2_BANDS = [
    (200, "Muy Alto (>200)"),
    (100, "Alto (100-200)"),
    (40, "Moderado (40-100)"),
]
NO2_ELSE = "Aceptable (≤40)"
# (share, label): measurements per hour must reach the share
AVAILABILITY_BANDS = [
    (0.8, "Excelente (≥80%)"),
    (0.6, "Buena (60-80%)"),
    (0.4, "Regular (40-60%)"),
]
AVAILABILITY_ELSE = "Deficiente (<40%)"
# parameter -> ([(upper limit, label)], label above the last limit)
WHO_LIMITS = {
    "pm25": (
        [
            (15, "Buena (OMS: ≤15)"),
            (25, "Moderada (OMS: 15-25)"),
            (50, "Dañina para grupos sensibles (25-50)"),
            (75, "Dañina para la salud (50-75)"),
        ],
        "Muy dañina (>75)",
    ),
    "pm10": (
        [
            (45, "Buena (OMS: ≤45)"),
            (75, "Moderada (OMS: 45-75)"),
            (150, "Dañina para grupos sensibles (75-150)"),
        ],
        "Dañina para la salud (>150)",
    ),
    "no2": (
        [
            (25, "Buena (OMS: ≤25)"),
            (50, "Moderada (25-50)"),
            (100, "Dañina para grupos sensibles (50-100)"),
        ],
        "Dañina para la salud (>100)",
    ),
    "o3": (
        [
            (60, "Buena (OMS: ≤60)"),
            (120, "Moderada (60-120)"),
            (180, "Dañina para grupos sensibles (120-180)"),
        ],
        "Dañina para la salud (>180)",
    ),
}
WHO_ELSE = "No evaluado"
# hour texts of the first date -> region
REGION_HOURS = [
    (("T01:00:00", "T02:00:00"), "Europa/África"),
    (("T05:00:00", "T06:00:00"), "Asia"),
    (("T08:00:00", "T09:00:00"), "Oceanía"),
]
REGION_ELSE = "América/Otros"
# name fragments -> sensor category
SENSOR_FRAGMENTS = [
    (("pm",), "Partículas (PM)"),
    (("no", "so", "o3"), "Gases"),
    (("temp", "hum"), "Meteorológicos"),
]
SENSOR_ELSE = "Otros"
QUADRANT_LATITUDE = -30
QUADRANT_LONGITUDE = -70
QUADRANTS = ("Norte-Este", "Norte-Oeste", "Sur-Este", "Sur-Oeste")
MOBILE_LABELS = ("Móvil", "Fijo")
MONITOR_LABELS = ("Monitor", "No Monitor")
# order of the parameters in the weekly summary; all others follow
PARAMETER_ORDER = ("pm25", "pm10", "no2", "co", "o3", "so2")
# ----------------------------------------------------------------------------


def case_label(rules: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """CASE with searched conditions; the first that is true wins."""
    (first, label), *rest = rules
    column = F.when(first, label)
    for condition, value in rest:
        column = column.when(condition, value)
    return column if otherwise is None else column.otherwise(otherwise)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def band_pm25_excess(mean: Column) -> Column:
    return case_label([(mean > low, text) for low, text in PM25_EXCESS_BANDS], PM25_EXCESS_ELSE)


def band_no2(mean: Column) -> Column:
    return case_label([(mean > low, text) for low, text in NO2_BANDS], NO2_ELSE)


def band_availability(per_hour: Column) -> Column:
    """NULL where the rate is unknown (a sensor with a single measurement)."""
    label = case_label([(per_hour >= low, text) for low, text in AVAILABILITY_BANDS], AVAILABILITY_ELSE)
    return F.when(per_hour.isNotNull(), label)


def band_who(parameter: Column, mean: Column) -> Column:
    per_parameter = [
        (parameter == name, case_label([(mean <= top, text) for top, text in limits], above))
        for name, (limits, above) in WHO_LIMITS.items()
    ]
    return case_label(per_parameter, WHO_ELSE)


def bucket_region(first_date_text: Column) -> Column:
    """Region guessed from the hour in the ISO text as delivered (with its ``T``)."""
    rules = [
        (_any([first_date_text.contains(h) for h in hours]), region)
        for hours, region in REGION_HOURS
    ]
    return case_label(rules, REGION_ELSE)


def bucket_sensor(sensor_name: Column) -> Column:
    rules = [
        (_any([sensor_name.ilike(f"%{part}%") for part in parts]), category)
        for parts, category in SENSOR_FRAGMENTS
    ]
    return case_label(rules, SENSOR_ELSE)


def bucket_quadrant(latitude: Column, longitude: Column) -> Column:
    north, east = latitude >= QUADRANT_LATITUDE, longitude >= QUADRANT_LONGITUDE
    north_east, north_west, south_east, south_west = QUADRANTS
    return case_label([(north & east, north_east), (north, north_west), (east, south_east)], south_west)


def bool_label(flag: Column, labels: tuple[str, str]) -> Column:
    """Text for true and for false; NULL reads as false."""
    yes, no = labels
    return F.when(F.coalesce(flag, F.lit(False)), yes).otherwise(no)


def parameter_rank(parameter: Column) -> Column:
    rules = [(parameter == name, F.lit(i)) for i, name in enumerate(PARAMETER_ORDER, start=1)]
    return case_label(rules, F.lit(len(PARAMETER_ORDER) + 1))
