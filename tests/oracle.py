"""Run registered queries on Spark and their SQL on DuckDB and compare the results."""

from __future__ import annotations

import sys
import time

import duckdb

from tidemark.session import TABLES, build_session


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return ("f", float(f"{value:.12g}"))
    return (type(value).__name__, value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_cell(r[i]) for i in order)) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs. Value types must agree too."""
    left_names = spark_df.columns
    left = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    right_names = [d[0] for d in cursor.description]
    right = cursor.fetchall()
    if sorted(left_names) != sorted(right_names):
        return f"columns {sorted(left_names)} != {sorted(right_names)}"
    a, b = _rows(left_names, left), _rows(right_names, right)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"rows {len(a)} vs {len(b)}; {sorted(left_names)}\n   spark {only_a}\n   duck  {only_b}"
    frame = con.execute(sql).df()
    for name, kind in spark_df.dtypes:
        wanted = {"bigint": "i", "int": "i", "double": "f", "string": "O", "boolean": "b"}.get(kind)
        got = frame[name].dtype.kind
        if wanted and got != wanted and not frame[name].isna().any() and len(frame) and not (wanted == "O"):
            return f"column {name}: {kind} vs pandas {frame[name].dtype}"
    return None if a or "/*empty ok*/" in sql else "EMPTY"


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    path = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(path), oracle_sql(), []
    for name, run in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            df = run(spark, path)
            problem = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        seconds = time.time() - begin
        if problem:
            bad.append(name)
        print(f"{'ok ' if not problem else 'BAD'} {name} {seconds:.2f}s {problem or ''}", flush=True)
    print(f"{len(bad)} not ok: {bad}")


if __name__ == "__main__":
    main(sys.argv)
