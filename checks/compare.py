"""Run queries and their SQL twins side by side and report differences."""

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def difference(df, con, sql):
    """None if the DataFrame equals the SQL result, else what differs."""
    result = con.sql(sql)
    want_columns, want_types = list(result.columns), [str(t) for t in result.types]
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    types = {name: SPARK_TO_SQL.get(kind, kind) for name, kind in df.dtypes}
    wrong = {n: (types[n], t) for n, t in zip(want_columns, want_types) if types[n] != t}
    got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    want = normal_rows(want_columns, result.fetchall())
    if got != want:
        extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return f"rows {len(got)} != {len(want)}; extra {extra[:2]}, missing {missing[:2]}"
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from checks.oracle import ORACLES
    from checks.queries import QUERIES
    from trolley.session import build_session

    folder, *names = sys.argv[1:]
    session = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                              "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](session, folder)
            if name in ORACLES:
                problem, kind = difference(df, con, ORACLES[name]), "sql"
            else:
                problem, kind = (None, f"rows {df.count()}")
        except Exception as error:
            problem, kind = f"{type(error).__name__}: {str(error)[:600]}", "error"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {kind:10} {name}"
              + (f"\n     {problem}" if problem else ""), flush=True)
    print("failed:", failed)
