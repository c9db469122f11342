"""Scalar column functions. None of them reads a clock: pass ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOURS = "decimal(20,6)"


def fn_round(x: Column, digits: int) -> Column:
    """Half away from zero, on DECIMAL."""
    return F.round(x, digits)


def fn_cast(x: Column, type_: str) -> Column:
    return x.cast(type_)


def difference(a: Column, b: Column) -> Column:
    return a - b


def percent_over(x: Column, base: Column | int, digits: int = 1) -> Column:
    """How far x lies above the base, in percent of the base."""
    base = base if isinstance(base, Column) else F.lit(base)
    return F.round(F.try_divide(x - base, base) * 100, digits)


def z_score(x: Column, mean: Column, sd: Column) -> Column:
    """Distance from the mean in standard deviations; NULL for sd = 0."""
    return F.try_divide(x.cast("double") - mean.cast("double"), sd)


def guarded_div(n: Column, d: Column, digits: int = 2) -> Column:
    """n / d if d > 0, else 0."""
    quotient = F.round(F.try_divide(n.cast("decimal(18,0)"), d.cast("decimal(18,0)")), digits)
    return F.when(d > 0, quotient).otherwise(F.lit(0))


def percent_of(n: Column, total: Column, digits: int = 1) -> Column:
    """Share of the total in percent; 0 for an empty total."""
    share = F.try_divide(n.cast("decimal(20,0)") * 100, total.cast("decimal(20,0)"))
    return F.coalesce(F.round(share, digits), F.lit(0))


def substr_year(text: Column) -> Column:
    return F.substring(text, 1, 4)


def concat_key(*parts: Column, sep: str = "-") -> Column:
    """Parts joined by a separator; NULL if any part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def date_of(ts: Column) -> Column:
    return F.to_date(ts)


def year_of(ts: Column) -> Column:
    return F.year(ts).cast("bigint")


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days of a timestamp difference, cut off toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds as DECIMAL; zone-less, so no daylight-saving step can enter."""
    return (later - earlier).cast("interval second").cast(_HOURS)


def epoch_hours(later: Column, earlier: Column) -> Column:
    return F.try_divide(seconds_between(later, earlier), F.lit(3600).cast(_HOURS))


def julian_days(later: Column, earlier: Column) -> Column:
    """Days between, rounded to the nearest whole day."""
    days = F.try_divide(seconds_between(later, earlier), F.lit(86400).cast(_HOURS))
    return F.round(days, 0).cast("bigint")


def duration(later: Column, earlier: Column) -> Column:
    """Difference as a day-time interval; it can be sorted by."""
    return later - earlier


def json_length(json: Column) -> Column:
    """Elements of a JSON array; NULL if the text is no array."""
    return F.json_array_length(json).cast("bigint")


def json_elements(json: Column) -> Column:
    """Elements of a JSON array as text; objects stay JSON text."""
    return F.from_json(json, "array<string>")


def or_default(x: Column, default: object) -> Column:
    return F.coalesce(x, F.lit(default))
