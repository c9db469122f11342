"""Registry of named queries, and the model tables in SQL for the cross-check."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.bindings import Model
from brisa.session import prepare


@dataclass(frozen=True)
class Entry:
    run: Callable[[Model], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def register(key: str, run: Callable[[Model], DataFrame], sql: str | None = None) -> None:
    if key in ENTRIES:
        raise KeyError(f"{key} is registered twice")
    ENTRIES[key] = Entry(run, with_model(sql) if sql else None)


def query(key: str, sql: str | None = None):
    """Decorator form of ``register``."""

    def keep(run: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
        register(key, run, sql)
        return run

    return keep


def comparable(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE, as both engines print these alike."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def runner(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return comparable(entry.run(Model(spark, folder)))

    return run


# --- SQL side -----------------------------------------------------------------

def mean_sql(x: str, digits: int, scale: int = 6) -> str:
    """Mean of a DECIMAL column, rounded half away from zero in whole numbers.

    DuckDB averages DECIMALs as DOUBLE, which can round a tie the other way.
    """
    total = f"sum(CAST({x} * {10**scale} AS BIGINT))"
    unit = f"(count({x}) * {10 ** (scale - digits)})"
    return (
        f"CAST(sign({total}) * ((2 * abs({total}) + {unit}) // (2 * {unit})) "
        f"/ {10**digits}.0 AS DOUBLE)"
    )


def ratio_sql(n: str, d: str, digits: int) -> str:
    """Quotient of two whole numbers, rounded half up; NULL for a divisor of 0."""
    return (
        f"CASE WHEN {d} = 0 THEN NULL ELSE "
        f"CAST((2 * CAST({n} AS HUGEINT) * {10**digits} + {d}) // (2 * {d}) / {10**digits}.0 AS DOUBLE) END"
    )


def dbl(x: str, digits: int = 2) -> str:
    return f"CAST(round({x}, {digits}) AS DOUBLE)"


_POSITION = (
    "CAST(-56 + ({k} * 7919 % 3900) / 100.0 AS DECIMAL(10,8)) AS latitude, "
    "CAST(-76 + ({k} * 104729 % 900) / 100.0 AS DECIMAL(11,8)) AS longitude"
)

PARAMETER_CASE = (
    "CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10' WHEN 'purchase' THEN 'no2' "
    "WHEN 'signup' THEN 'o3' ELSE 'so2' END"
)

# Model tables by name; a query gets those that it mentions as WITH clauses.
MODEL_SQL = {
    "measurements": f"""
        SELECT event_id AS id, user_id AS sensor_id, user_id % 25 AS location_id,
               {PARAMETER_CASE} AS parameter_name, 'ug/m3' AS parameter_units,
               CAST(value AS DECIMAL(15,6)) AS value, date_trunc('hour', ts) AS period_from_utc,
               date_trunc('hour', ts) + INTERVAL 1 HOUR AS period_to_utc, event_type AS period_label,
               value > 200 AS has_flags, props AS raw_data, ts AS arrived_at
        FROM events""",
    "station": f"""
        SELECT l_suppkey AS id, s_name AS name, n_name AS locality, s_nationkey AS country_id,
               p_size AS provider_id, p_brand AS provider_name, l_partkey AS sensor_id,
               p_type AS sensor_name, {_POSITION.format(k="l_suppkey")}, r_name AS timezone,
               l_returnflag = 'A' AS is_mobile, l_linestatus = 'O' AS is_monitor,
               l_shipdate AS extracted_at
        FROM lineitem
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        LEFT JOIN nation ON n_nationkey = s_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN part ON p_partkey = l_partkey""",
    "countries": """
        SELECT n_nationkey AS country_id, n_name AS code, n_name AS name,
               first_order AS "datetimeFirst", last_order AS "datetimeLast",
               strftime(first_order, '%Y-%m-%dT%H:%M:%S') AS "datetimeFirst_raw",
               CASE n_nationkey % 4 WHEN 0 THEN '["pm25","pm10","o3"]' WHEN 1 THEN '["pm25","no2"]'
                    WHEN 2 THEN '["o3"]' ELSE '[]' END AS parameters,
               customers AS locations, COALESCE(suppliers, 0) AS sources, last_order AS extracted_at
        FROM nation
        JOIN (SELECT c_nationkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
                     count(DISTINCT c_custkey) AS customers
              FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_nationkey)
          ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY s_nationkey)
          ON s_nationkey = n_nationkey""",
    "locations": f"""
        SELECT c_custkey AS location_id, c_name AS name, c_mktsegment AS locality, r_name AS timezone,
               n_name AS country_code, n_name AS country_name, c_acctbal < 0 AS is_mobile,
               c_custkey % 2 = 0 AS is_monitor, {_POSITION.format(k="c_custkey")},
               CASE c_custkey % 3
                 WHEN 0 THEN '[{{"id":' || c_custkey * 10 ||
                   ',"parameter":{{"name":"pm25","units":"ug/m3"}}}},{{"id":' || c_custkey * 10 + 1 || '}}]'
                 WHEN 1 THEN '[]'
                 ELSE '[{{"id":' || c_custkey * 10 ||
                   ',"parameter":{{"name":"o3","units":"ppm"}}}},{{"parameter":{{"name":"no2","units":"ppb"}}}}]'
               END AS sensors,
               first_order AS datetime_first, last_order AS datetime_last, last_order AS extracted_at
        FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
                   FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "parameters": """
        SELECT p_partkey AS parameter_id, p_type AS name, p_name AS display_name, p_brand AS units
        FROM part""",
    "posts": """
        SELECT conv_id * 1000 + turn AS id, conv_id AS user_id, role AS title, text AS body
        FROM conversations""",
    # events as payload records: what is missing or wrong in some of them
    "records": f"""
        SELECT event_id, user_id AS sensor_id, user_id % 25 AS location_id, value,
               {PARAMETER_CASE} AS parameter_name, event_type, date_trunc('hour', ts) AS hour, ts,
               event_id % 20 AS part, event_id // 1000 + 1 AS page,
               row_number() OVER (PARTITION BY user_id, event_id // 1000 ORDER BY event_id) - 1 AS pos
        FROM events""",
}


def with_model(sql: str) -> str:
    used = [name for name in MODEL_SQL if re.search(rf"\b{name}\b", sql)]
    body = sql.strip()
    if not used:
        return body
    tables = ", ".join(f"{name} AS ({MODEL_SQL[name]})" for name in used)
    if body[:4].upper() == "WITH":
        return f"WITH {tables}, {body[4:].lstrip()}"
    return f"WITH {tables} {body}"
