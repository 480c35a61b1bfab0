"""Run every registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{root}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "as_tuple"):
        return float(value)
    return str(value)


def sortable(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in rows), key=sortable
    )


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def differences(df, con, sql) -> list[str]:
    found, wanted = spark_rows(df), duck_rows(con, sql)
    if found[0] != wanted[0]:
        return [f"columns {found[0]} != {wanted[0]}"]
    if len(found[1]) != len(wanted[1]):
        return [f"{len(found[1])} rows != {len(wanted[1])}"]
    return [f"{a} != {b}" for a, b in zip(found[1], wanted[1], strict=True) if a != b]


def main(root: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from souk.session import local_session

    spark = local_session("compare")
    con = connect(root)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, root)
            if name in sql:
                wrong = differences(df, con, sql[name])
                note = "ok" if not wrong else f"{len(wrong)} DIFFERENCES {wrong[:3]}"
            else:
                wrong, note = [], f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            wrong, note = ["error"], f"ERROR {type(error).__name__} {str(error)[:600]}"
        failed += bool(wrong)
        print(f"{name:32s} {time.time() - start:6.1f}s {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
