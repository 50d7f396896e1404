"""Run registered queries and compare them with their DuckDB twins: ``python tests/compare.py [folder] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    try:
        return f"{float(value):.6f}" if not isinstance(value, int) else int(value)
    except TypeError:
        return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, connection, twin: str) -> str | None:
    """None when both results agree, else a short account of the first differences."""
    cursor = connection.execute(twin)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = rows_of(names, cursor.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if actual != expected:
        only_spark, only_sql = actual - expected, expected - actual
        return (
            f"rows {sum(actual.values())} vs {sum(expected.values())}\n  spark: {str(list(only_spark)[:2])[:700]}"
            f"\n  sql:   {str(list(only_sql)[:2])[:700]}"
        )
    numeric = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if numeric.get(t, t).split("(")[0] != kinds[c].split("(")[0]]
    return f"types {odd}" if odd and os.environ.get("STRICT_TYPES") else None


def main() -> int:
    import __spark_entry__ as entry
    from caseweave.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]",
        **{"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    connection, twins, failed = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in twins:
                problem = difference(df, connection, twins[name])
                outcome = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                outcome = f"rows only: {df.count()}"
        except Exception as problem:  # noqa: BLE001
            outcome = f"FAILED {str(problem)[:900]}"
        failed += outcome.startswith(("DIFFERS", "FAILED"))
        print(f"{name:28s} {time.time() - start:6.1f}s  {outcome}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
