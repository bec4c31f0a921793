"""Rate limits, bursts and lock-outs against a walk through single attempts."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from murmur.operators import guards, machines

EPOCH = datetime(2026, 1, 1)
BASE = int(EPOCH.replace(tzinfo=timezone.utc).timestamp())


def attempts(seed, n, span, users="aaaabc"):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        burst = rng.randrange(0, span, 40) if rng.random() < 0.5 else rng.randrange(span)
        rows.append((i, EPOCH + timedelta(seconds=burst, microseconds=i), rng.choice(users), rng.random() < 0.7))
    return sorted(rows, key=lambda r: (r[2], r[1], r[0]))


def log(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, timestamp TIMESTAMP, user STRING, failed BOOLEAN")


def second(row):
    return BASE + int((row[1] - EPOCH).total_seconds())


@pytest.fixture(autouse=True)
def several_blocks(monkeypatch):
    monkeypatch.setattr(guards, "BLOCK", 1000)
    monkeypatch.setattr(machines, "ROWS", 1)


@pytest.mark.parametrize("seed, limit, seconds", [(1, 3, 60), (2, 5, 120), (3, 1, 10), (4, 15, 300)])
def test_sliding_log(spark, seed, limit, seconds):
    rows = attempts(seed, 900, 6000)
    expected, held = {}, {}
    for row in rows:
        recent = held[row[2]] = [t for t in held.get(row[2], []) if second(row) - t < seconds]
        if len(recent) >= limit:
            expected[row[2], second(row)] = expected.get((row[2], second(row)), 0) + 1
        else:
            recent.append(second(row))
    got = guards.sliding_window_refusals(log(spark, rows), "user", limit, seconds).collect()
    assert {(r["key"], r["second"]): r["refused"] for r in got} == expected
    assert expected


@pytest.mark.parametrize("seed, seconds", [(1, 900), (2, 60), (3, 10)])
def test_lockouts(spark, seed, seconds):
    rows = attempts(seed, 1200, 9000)
    expected, state = [], {}
    for row in rows:
        counter, until = state.get(row[2], (0, -1))
        if second(row) < until:
            continue
        counter = counter + 1 if row[3] else 0
        until = -1
        if row[3] and counter >= 5:
            until = second(row) + seconds
            expected.append((row[2], second(row), until, counter))
        state[row[2]] = (counter, until)
    got = guards.lockouts(log(spark, rows), "user", "id", F.col("failed"), 5, seconds).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)
    assert expected


def counted_passes(monkeypatch):
    passes, settle = [], machines.settle
    monkeypatch.setattr(machines, "settle", lambda df, name: passes.append(name) or settle(df, name))
    return passes


@pytest.mark.parametrize("gaps", [False, True])
def test_a_key_refused_throughout_is_run_in_blocks(spark, monkeypatch, gaps):
    """Two users try every second or nearly so, over 20 blocks of 20 spans; a steady one never forgets how it began."""
    monkeypatch.setattr(guards, "BLOCK", 200)
    monkeypatch.setattr(machines, "ROWS", 1)
    passes = counted_passes(monkeypatch)
    rng = random.Random(8)
    rows = [(i, EPOCH + timedelta(seconds=i // 2), "ab"[i % 2], True) for i in range(8000) if not (gaps and rng.random() < 0.1)]
    expected, held = {}, {}
    for row in rows:
        recent = held[row[2]] = [t for t in held.get(row[2], []) if second(row) - t < 10]
        if len(recent) >= 3:
            expected[row[2], second(row)] = 1
        else:
            recent.append(second(row))
    got = guards.sliding_window_refusals(log(spark, rows), "user", 3, 10).collect()
    assert {(r["key"], r["second"]): r["refused"] for r in got} == expected and len(expected) > 4000
    assert passes.count("tried") <= (12 if gaps else 2)
    passes.clear()
    locks, state = [], {}
    for row in rows:
        counter, until = state.get(row[2], (0, -1))
        if second(row) >= until:
            counter, until = counter + 1, -1
            if counter >= 5:
                until = second(row) + 10
                locks.append((row[2], second(row), until, counter))
            state[row[2]] = counter, until
    got = guards.lockouts(log(spark, rows), "user", "id", F.col("failed"), 5, 10).collect()
    assert sorted(tuple(r) for r in got) == sorted(locks) and max(r[3] for r in locks) > 40
    assert passes.count("tried") <= (12 if gaps else 2)


def test_rules_run_without_python(spark):
    rows = log(spark, attempts(1, 200, 2000))
    for df in (guards.sliding_window_refusals(rows, "user", 3, 60), guards.lockouts(rows, "user", "id", F.col("failed"), 5, 60)):
        assert "Python" not in df._jdf.queryExecution().toString() and "Pandas" not in df._jdf.queryExecution().toString()


def test_fixed_window(spark):
    rows = [(i, EPOCH + timedelta(seconds=i // 2), "a", False) for i in range(10)]
    got = guards.fixed_window_breaches(log(spark, rows), "user", 3, 4).collect()
    assert [(r["window_second"] - BASE, r["attempts"], r["refused"]) for r in got] == [(0, 8, 5)]
