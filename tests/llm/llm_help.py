from collections import defaultdict

import duckdb


def connect(folder: str):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return db


def by_id(rows: list[dict]) -> dict:
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(r)
    return out
