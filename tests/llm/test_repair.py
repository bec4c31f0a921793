"""Repaired conversations against plain Python, the cheapest edits against all edits, and chunks against the whole."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from murmur.llm import repair
from murmur.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, part int, audit string"
ROLES = ["user", "assistant", "user", "assistant", "user", "assistant", "system", "tool", "utility", "", None]
TEXTS = ["Yes.", "Is it so?", "Go on!", "cut of", "", " \n", " ", "same.", "same", None, "a\nb.", "Well. \t", "é漢."]
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        told = [" " if x is None else str(x) for x in (conv, turn)]
        case = zlib.crc32(":".join(told).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case:
            text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
            own += [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0], r[1].encode(), r[2].encode())) for c, own in out.items()}


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        body = [c for c in text if c not in BLANKS]
        found.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """(cost, audit, lines) by forward steps over the best so far of each state: what is written ends in ''/s/u/a."""
    follows = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    best = {"": (0, "", ())}

    def inserts():
        for _ in range(3):
            for q, (cost, audit, lines) in list(best.items()):
                for to, name in (("u", "user:"), ("a", "assistant:")):
                    if (q, to) in follows:
                        new = cost + 5, audit + "I", (*lines, name)
                        best[to] = min(best.get(to, new), new)
    inserts()
    for (_, role, text), fault in zip(rows, found):
        new = {}
        for q, (cost, audit, lines) in best.items():
            options = [(q, cost + 2, "D", ())]
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                if (q, role[:1]) in follows:
                    options.append((role[:1], cost + more, "K", (f"{role}:{text}",)))
                options += [(n[0], cost + more + 1, "R", (f"{n}:{text}",)) for n in ("user", "assistant") if (q, n[0]) in follows]
            for to, c, letter, line in options:
                if to in ("", "s", "u", "a"):
                    own = c, audit + letter, lines + line
                    new[to] = min(new.get(to, own), own)
        best = new
        inserts()
    return min(best[q] for q in ("", "a") if q in best)


def plain(rows):
    out = {}
    for conv, own in damaged(rows).items():
        found = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, lines = cheapest(own, found)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out[conv] = {"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     "blank": found.count("b"), "duplicate": found.count("d"), "truncated": found.count("t"),
                     "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
                     "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
    return out


def conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(60):
        n = rng.choice([1, 1, 2, 5, 9, 14])
        kind = rng.random()
        for turn in range(n):
            role = ["user", "assistant"][turn % 2] if kind < 0.5 else rng.choice(ROLES)
            text = rng.choice(TEXTS) if rng.random() < 0.4 else f"Line {turn} of {conv}."
            rows.append((conv, rng.choice([turn, turn, turn, turn * 2, None, 3]), role, text))
    rows += [(None, t, ["user", "assistant"][t % 2], f"No id {t}!") for t in range(30)]
    rows += [(-5, t, "user", f"Only user {t}.") for t in range(150)]  # what is cheapest depends on the far end
    rows += [(-6, t, "tool", f"Only tool {t}.") for t in range(151)]
    rows += [(-7, t, rng.choice(ROLES), rng.choice(TEXTS)) for t in range(400)]  # much is there twice
    rows += [(-8, 7, "user", "one and the same")] * 120
    rows += [(-9, t, "", "") for t in range(90)]
    rng.shuffle(rows)
    return rows + rows[:20]


def told(spark, folder, rows):
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(6).write.parquet(f"{folder}/conversations.parquet")
    found = [r.asDict() for r in QUERIES["op13_conversation_repair"](spark, str(folder)).collect()]
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: r for r in found}


def test_same_as_plain_python(spark, tmp_path):
    assert told(spark, tmp_path, conversations()) == plain(conversations())


def test_same_in_small_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_ROWS", 7)
    assert told(spark, tmp_path, conversations()) == plain(conversations())


def test_dropped_conversations_and_empty_table(spark, tmp_path):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, 0, "user", "Well.") for c in gone]
    nothing = hashlib.sha256(b"").hexdigest()
    found = told(spark, tmp_path / "a", rows)
    assert sorted(found) == gone and len(gone) > 5
    assert {tuple(r.values())[1:] for r in found.values()} == {(0, 0, 0, 0, 0, 0, "", nothing)}
    assert told(spark, tmp_path / "b", []) == {}


def test_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: r.asDict() for r in QUERIES["op13_conversation_repair"](spark, folder).collect()}
    assert found == plain(rows)


@pytest.mark.parametrize("seed", range(4))
def test_cheapest_of_all_edits(seed):
    rng = random.Random(seed)
    costs = repair.Costs()
    for _ in range(25):
        rows = [(0, rng.choice(["system", "user", "assistant", "x"]), f"{i}") for i in range(rng.randrange(4))]
        found = [rng.choice(["", "", "", "t", "b"]) for _ in rows]
        options = []
        for edits in itertools.product("DKus", repeat=len(rows)):  # u, s: a new role, user or assistant
            for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
                written, audit, cost = gaps[0], "I" * len(gaps[0]), 5 * sum(map(len, gaps))
                for (_, role, _), fault, e, gap in zip(rows, found, edits, gaps[1:]):
                    if fault == "b" and e != "D":
                        cost += 1000
                    cost += {"D": 2, "K": 0}.get(e, 1) + (5 if fault == "t" and e != "D" else 0)
                    written += {"D": "", "K": role[0], "u": "u", "s": "a"}[e] + gap
                    audit += (e if e in "DK" else "R") + "I" * len(gap)
                if re.fullmatch("(s?(ua)+)?", written):
                    options.append((cost, audit))
        codes = bytes(repair.INITIALS.get(r[0], 3) + 4 * {"": 0, "b": 1, "t": 3}[f] for (_, r, _), f in zip(rows, found))
        vectors, off = costs.backward(codes, repair.ENDED)
        letters, state = costs.forward(codes, vectors, repair.START)
        assert min(options) == (vectors[-1][0] + off, "".join(letters) + "I" * len(repair.finish(state)))
        assert cheapest(rows, found)[:2] == min(options)


def test_chunks_that_remember_their_end_need_few_passes(spark, monkeypatch):
    """Rows of one role: each chunk's vector hangs on how many rows come after it, so no chunk forgets its end."""
    monkeypatch.setattr(repair, "CHUNK_ROWS", 3)
    passes = []
    settled = repair.settled
    monkeypatch.setattr(repair, "settled", lambda df, name: passes.append(name) or settled(df, name))
    rows = [(1, t, "tool", f"Row {t}.", False) for t in range(200)]
    found = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, dropped boolean")).collect()
    assert [(r.cost, r.audit) for r in found] == [(200, "R" * 200)]
    assert passes.count("known") <= 4


def test_same_as_sql(tmp_path, spark):
    import duckdb

    from murmur.llm.oracle import SQL
    spark.createDataFrame([(*r, 1, "x") for r in conversations()], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    result = db.execute(SQL["op13_conversation_repair"])
    names = [d[0] for d in result.description]
    assert {r[0]: dict(zip(names, r)) for r in result.fetchall()} == plain(conversations())
