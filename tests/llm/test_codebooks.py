"""Vector codes against plain Python, and vectors that are no vectors."""

import hashlib
import math
import random

import numpy as np
import pytest

from murmur.llm import codebooks
from murmur.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, Error int"


def plain(rows: list[tuple]) -> list[dict]:
    """The contract word for word, over (vec_id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // 8
    part = lambda v, p: tuple(v[p * width:(p + 1) * width])
    first = {}
    for i, v, _ in kept:
        if i is not None:
            first[i] = min(v, first.get(i, v))
    seeds = [first[i] for i in sorted(first)[:16]]
    books = [[part(v, p) for v in seeds] for p in range(8)]

    def near(x, book):
        return min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x, book[e])), e))
    for _ in range(6):
        for p in range(8):
            members = [[] for _ in books[p]]
            for _, v, _ in kept:
                members[near(part(v, p), books[p])].append(part(v, p))
            books[p] = [tuple(sum(c) // len(m) for c in zip(*m)) if m else e for m, e in zip(members, books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, label in kept:
        at = [near(part(v, p), books[p]) for p in range(8)]
        error = sum((a - b) ** 2 for p in range(8) for a, b in zip(part(v, p), books[p][at[p]]))
        out.append({"vec_id": i, "code": "".join(f"{a:02x}" for a in at), "error": error, "label": label, "codebooks_sha256": digest})
    for r in out:
        r["label_error"] = sum(x["error"] for x in out if x["label"] == r["label"])
    return [{k: v for k, v in r.items() if k != "label"} for r in out]


def vectors() -> list[tuple]:
    rng = random.Random(3)
    some = lambda: [float(np.float32(rng.gauss(0, 0.3))) for _ in range(16)]
    rows = [(i, some(), rng.choice([0, 1, None])) for i in range(40, 240)]
    hot = some()
    rows += [(i, hot, 2) for i in range(240, 360)] + [(i, [0.0] * 16, 3) for i in range(360, 380)]
    rows += [(50, rows[10][1], 9), rows[0], rows[0], (45, some(), 1), (None, some(), None), (None, hot, 4)]  # repeats, one id twice, no id
    rows += [(1, None, 0), (2, [float("nan")] + [0.0] * 15, 0), (3, [None] + [0.0] * 15, 0), (4, [float("-inf")] + [0.0] * 15, 1)]
    rng.shuffle(rows)
    return rows


def table(spark, folder, rows):
    spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(5).write.parquet(f"{folder}/embeddings.parquet")
    return [r.asDict() for r in QUERIES["op11_vector_codes"](spark, str(folder)).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: repr(sorted(r.items())))


def test_same_as_plain_python(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(codebooks, "BLOCK", 1 << 12)  # many blocks
    rows = vectors()
    assert ordered(table(spark, tmp_path, rows)) == ordered(plain(rows))


def test_fewer_ids_than_entries(spark, tmp_path):
    rows = [r for r in vectors() if r[0] in (40, 41, 45, 50) or r[0] is None]
    assert ordered(table(spark, tmp_path, rows)) == ordered(plain(rows))


def test_no_ids_and_empty_table(spark, tmp_path):
    found = table(spark, tmp_path / "a", [(None, [0.5] * 8, 1)])
    assert [(r["code"], r["error"]) for r in found] == [(None, None)]
    assert table(spark, tmp_path / "b", []) == []
    assert table(spark, tmp_path / "c", [(1, None, 1)]) == []


def test_other_lengths_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="one length"):
        table(spark, tmp_path, [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)])


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(1)
    parts, entries = rng.integers(-codebooks.LARGEST, codebooks.LARGEST, (50, 8)), rng.integers(-codebooks.LARGEST, codebooks.LARGEST, (16, 8))
    index, apart = codebooks.nearest(parts, entries)
    for x, i, d in zip(parts.tolist(), index.tolist(), apart.tolist()):
        every = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in entries.tolist()]
        assert d == min(every) and i == every.index(d)


def test_new_columns_get_other_names(spark, tmp_path):
    rows = spark.createDataFrame([(1, [0.5] * 8, 1, "x", 5)], SCHEMA)
    assert codebooks.compress(rows)[0].columns == ["vec_id", "embedding", "label", "codes", "Error", "codes_", "error_", "label_error"]


def test_same_as_sql(spark, tmp_path):
    import duckdb

    from murmur.llm.oracle import SQL
    found = table(spark, tmp_path, vectors())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    result = db.execute(SQL["op11_vector_codes"])
    names = [d[0] for d in result.description]
    assert ordered(found) == ordered([dict(zip(names, r)) for r in result.fetchall()])
