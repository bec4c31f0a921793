"""Run queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value) if isinstance(value, float) else value  # to the last bit, sign of zero included


def spark_rows(df):
    columns = sorted(df.columns)
    types = dict(df.dtypes)
    rows = [tuple(_cell(r[c]) for c in columns) for r in df.collect()]
    return columns, [types[c] for c in columns], sorted(rows, key=repr)


def sql_rows(db, sql: str):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in result.fetchall()]
    return sorted(names), [types[n] for n in sorted(names)], sorted(rows, key=repr)


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(df, db, sql: str) -> tuple[str, int]:
    """What differs in columns, types or rows, empty if nothing does; and the number of rows."""
    names, types, rows = spark_rows(df)
    sql_names, sql_types, expected = sql_rows(db, sql)
    if names != sql_names:
        return f"columns {names} != {sql_names}", 0
    kinds = [SAME_TYPE.get(t, t) for t in types]
    if kinds != sql_types:
        return f"types {dict(zip(names, kinds))} != {sql_types}", 0
    if rows != expected:
        only = [r for r in rows if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(rows)][:2]
        return f"rows {len(rows)} / {len(expected)}; only spark {str(only)[:600]}; only sql {str(missing)[:600]}", len(rows)
    return "", len(rows)


def main(sf_dir: str, names: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from murmur.session import build_session
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    db = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in sql:
                df = run(spark, sf_dir)
                problem, rows = differences(df, db, sql[name])
            else:
                problem, rows = "", run(spark, sf_dir).count()
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", ""
        bad += bool(problem)
        print(f"\n{'BAD' if problem else 'ok '} {name} {time.time() - start:.1f}s rows={rows} {problem}", flush=True)
    print("\nfailures", bad, "of", len(entry.queries()), "orphan sql", set(sql) - set(entry.queries()))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
