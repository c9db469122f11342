"""Row predicates and projections. ``as_of`` stands for the current date or time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ntz(moment: date | datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def midnight(as_of: date | datetime | str) -> datetime:
    """Start of the day of ``as_of``."""
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return datetime(moment.year, moment.month, moment.day)


def moment(as_of: date | datetime | str) -> datetime:
    if isinstance(as_of, str):
        return datetime.fromisoformat(as_of)
    return as_of if isinstance(as_of, datetime) else midnight(as_of)


def latest(df: DataFrame, ts: str) -> datetime:
    """Newest timestamp of the column, for reports that are given no ``as_of``."""
    return df.agg(F.max(ts)).first()[0] or datetime(1970, 1, 1)


def project(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Column choice; a mapping renames source -> result."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(source).alias(result) for source, result in columns.items()])
    return df.select(*columns)


def filter_eq(df: DataFrame, col: str, value: object) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def filter_in(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def like_any(cols: Sequence[str], patterns: Sequence[str]) -> Column:
    tests = [F.col(c).ilike(p) for c in cols for p in patterns]
    return reduce(lambda a, b: a | b, tests)


def filter_like_ci(df: DataFrame, cols: str | Sequence[str], *patterns: str) -> DataFrame:
    """Case-insensitive LIKE; several columns or patterns are joined by OR."""
    return df.where(like_any([cols] if isinstance(cols, str) else cols, patterns))


def filter_like_lower(df: DataFrame, cols: str | Sequence[str], pattern: str) -> DataFrame:
    """LOWER(col) LIKE pattern on any of the columns."""
    names = [cols] if isinstance(cols, str) else cols
    return df.where(reduce(lambda a, b: a | b, [F.lower(c).like(pattern) for c in names]))


def has_parameter(json: str, name: str, exact: bool = False) -> Column:
    """Does the JSON text mention the parameter?

    The default is a substring test, which also finds it inside longer names;
    ``exact`` compares the elements (plain names, or objects with a ``name``).
    """
    if not exact:
        return F.col(json).contains(name)
    elements = F.from_json(F.col(json), "array<string>")
    return F.exists(
        elements,
        lambda e: (e == name) | (F.coalesce(F.get_json_object(e, "$.name"), F.lit("")) == name),
    )


def filter_json_text(
    df: DataFrame, json: str, names: Sequence[str], match: str = "any", exact: bool = False
) -> DataFrame:
    tests = [has_parameter(json, n, exact) for n in names]
    combine = (lambda a, b: a | b) if match == "any" else (lambda a, b: a & b)
    return df.where(reduce(combine, tests))


def filter_null(df: DataFrame, null: Sequence[str] = (), not_null: Sequence[str] = ()) -> DataFrame:
    tests = [F.col(c).isNull() for c in null] + [F.col(c).isNotNull() for c in not_null]
    return df.where(reduce(lambda a, b: a & b, tests))


def filter_cmp(df: DataFrame, **above: float) -> DataFrame:
    """Keep rows whose columns are all above the given numbers."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) > v for c, v in above.items()]))


def filter_recent(df: DataFrame, ts: str, as_of: date | datetime | str, days: int) -> DataFrame:
    """From N days before today's midnight on.

    On the date-partitioned measurement table the same bound is put on the
    partition column, so that older folders are not opened.
    """
    start = midnight(as_of) - timedelta(days=days)
    if "period_date" in df.columns and ts == "period_from_utc":
        df = df.where(F.col("period_date") >= F.lit(start.date()))
    return df.where(F.col(ts) >= _ntz(start))


def filter_stale(df: DataFrame, ts: str, as_of: date | datetime | str, days: int = 30) -> DataFrame:
    return df.where(F.col(ts) < _ntz(moment(as_of) - timedelta(days=days)))


def filter_last_24h(df: DataFrame, ts: str, as_of: date | datetime | str) -> DataFrame:
    return df.where(F.col(ts) > _ntz(moment(as_of) - timedelta(days=1)))


def is_today(ts: str, as_of: date | datetime | str) -> Column:
    return F.to_date(ts) == F.lit(midnight(as_of).date())


def filter_today(df: DataFrame, ts: str, as_of: date | datetime | str) -> DataFrame:
    """Dated today; written as a half-open range, which a scan can push down."""
    start = midnight(as_of)
    return filter_halfopen(df, ts, start, start + timedelta(days=1))


def filter_halfopen(df: DataFrame, ts: str, start: object, end: object) -> DataFrame:
    type_ = df.schema[ts].dataType
    return df.where(
        (F.col(ts) >= F.lit(str(start)).cast(type_)) & (F.col(ts) < F.lit(str(end)).cast(type_))
    )


def filter_window(df: DataFrame, ts: str, start: object, end: object) -> DataFrame:
    """Closed range at both ends."""
    type_ = df.schema[ts].dataType
    return df.where(F.col(ts).between(F.lit(str(start)).cast(type_), F.lit(str(end)).cast(type_)))
