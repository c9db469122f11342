"""Run named queries in Spark and their SQL in DuckDB, and compare all rows.

    python tests/crosscheck.py [folder] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(value):
    """A form in which equal values of both engines are equal."""
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def type_difference(df, con, sql):
    theirs = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours = {name: SAME_TYPE.get(type_, type_) for name, type_ in df.dtypes}
    return {c: (ours[c], theirs.get(c)) for c in ours if ours[c] != theirs.get(c)}


def compare(spark, con, key, run, sql, folder):
    df = run(spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(ours), f"{len(ours)} rows, no SQL"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return len(ours), f"COLUMNS {sorted(df.columns)} != {sorted(columns)}"
    types = type_difference(df, con, sql)
    if types:
        return len(ours), f"TYPES {types}"
    if ours == theirs:
        return len(ours), None
    mine, other = Counter(ours) - Counter(theirs), Counter(theirs) - Counter(ours)
    shown = f"only Spark {list(mine)[:2]}, only SQL {list(other)[:2]}"
    return len(ours), f"ROWS {len(ours)}/{len(theirs)}, {shown}"


def main() -> int:
    import __spark_entry__ as contract
    from tests.session import local_session

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    queries, oracle = contract.queries(), contract.oracle_sql()
    chosen = args[1:] or list(queries)
    spark, con = local_session(), connect(folder)
    wrong = 0
    for key in chosen:
        start = time.time()
        try:
            n, problem = compare(spark, con, key, queries[key], oracle.get(key), folder)
        except Exception as error:  # shown per query, the others go on
            n, problem = 0, f"ERROR {type(error).__name__}: {str(error)[:600]}"
        wrong += problem is not None and "no SQL" not in problem
        print(f"{key:28} {n:7} rows {time.time() - start:6.2f} s  {problem or 'equal'}", flush=True)
    print(f"{len(chosen)} queries, {wrong} differ")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main())
