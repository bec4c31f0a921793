"""Sequential rules over one key's rows, in blocks of time that run at the same time.

A rule reads a key's rows in order and carries a small state. Each block is run from a
guessed state, all of them in parallel; then the blocks of a key are gone through in
order, by their outcomes alone, and a block whose true state was not tried yet is run
again, all such blocks at the same time, until every block's true state is known. Most
blocks forget their start (a quiet span, a success), so one more pass is enough. Where a
key is refused without a break the state moves on with time: a block that is waited for is taken
to do as it did from the nearest state tried, or else to hand its state on moved by a
block. So a steady key is done in two passes, and an unsteady one in few, as runs from
near states soon meet. Outcomes stay known: each pass settles one block of a key at least.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.text import bind
from murmur.session import settle


#: Rows that a block may hold where rows are few in time: blocks are then several times as long, and so fewer.
ROWS = 8192


class Rule(NamedTuple):
    """What a rule does, in column expressions over a state and a row.

    `step` gives struct(state, out) of a row, `out` an array of what is reported. `enter` is the
    state as a block's first row sees it, so that states that mean the same are equal.
    `alone` is the part of a state that decides, `joined` puts a block's outcome for it on the
    whole state, `moved` is the state some seconds later, and `apart` how far two states are, null
    if they can't be compared.
    """
    start: Column
    step: Callable[[Column, Column], Column]
    enter: Callable[[Column, Column], Column]
    moved: Callable[[Column, Column], Column]
    apart: Callable[[Column, Column], Column]
    alone: Callable[[Column], Column] = lambda state: state
    joined: Callable[[Column, Column], Column] = lambda state, end: end


def _run(rows: Column, state: Column, rule: Rule) -> Column:
    """The state after the rows."""
    return F.aggregate(rows, state, lambda s, row: rule.step(s, row)["state"])


def _reported(rows: Column, state: Column, rule: Rule, out: str) -> Column:
    """What the rule reports of the rows."""
    start = F.struct(state.alias("state"), F.array().cast(out).alias("out"))
    return F.aggregate(rows, start, lambda a, row: bind(rule.step(a["state"], row), lambda s: F.struct(
        s["state"].alias("state"), F.concat(a["out"], s["out"]).alias("out"))), lambda a: a["out"])


def run_rule(rows: DataFrame, rule: Rule, out: str, block: int = 86_400) -> DataFrame:
    """(key, out) for every report of `rule` over rows (key, second, ...), one row a key and second at most.

    `out` is the type of the reports, an array of structs. A block holds at most `block`
    rows of a key, and is as many times `block` long as the fullest one allows by ROWS. Of a
    key only a row for each block passes through one task.
    """
    rows = settle(rows, "rows")
    fullest = rows.groupBy("key", F.floor(F.col("second") / block)).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    block *= max(1, ROWS // (fullest or ROWS))
    at = F.floor(F.col("second") / block)
    values = F.struct("second", *[c for c in rows.columns if c not in ("key", "second")])
    blocks = settle(rows.groupBy("key", at.alias("block")).agg(F.array_sort(F.collect_list(values)).alias("rows")), "blocks")
    tried = settle(blocks.select("key", "block", F.get("rows", F.lit(0)).alias("first"), rule.start.alias("start"),
                                 _run(F.col("rows"), rule.start, rule).alias("end")), "tried")
    while True:
        outcomes = tried.groupBy("key", "block").agg(F.first("first").alias("first"), F.collect_list(F.struct("start", "end")).alias("tried"))
        chains = outcomes.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", "first", "tried"))).alias("chain"))
        walked = settle(chains.select("key", F.inline(_walk(F.col("chain"), tried, rule, block))), "walked")
        unknown = walked.where(~F.col("known"))
        if unknown.isEmpty():
            break
        again = unknown.select("key", "block", rule.alone(F.col("state")).alias("start")).join(blocks, ["key", "block"])
        tried = tried.unionByName(settle(again.select(
            "key", "block", F.get("rows", F.lit(0)).alias("first"), "start", _run(F.col("rows"), F.col("start"), rule).alias("end")), "tried"))
    return walked.join(blocks, ["key", "block"]).select("key", F.inline(_reported(F.col("rows"), F.col("state"), rule, out)))


def _walk(chain: Column, tried: DataFrame, rule: Rule, block: int) -> Column:
    """(block, state, known) for each block of a key: the state it begins with, or a guess where one before is not known."""
    state_type = tried.schema["start"].dataType.simpleString()
    met_type = f"array<struct<block:bigint,state:{state_type},known:boolean>>"

    def step(a: Column, b: Column) -> Column:
        def met(state: Column) -> Column:
            own = rule.alone(state)
            known = F.exists(b["tried"], lambda t: t["start"].eqNullSafe(own))
            tried = F.filter(F.transform(b["tried"], lambda t: F.struct(
                F.when(t["start"].eqNullSafe(own), F.lit(-1).cast("bigint")).otherwise(rule.apart(own, t["start"])).alias("apart"),
                t["end"].alias("end"))), lambda t: t["apart"].isNotNull())
            return bind(F.struct(state.alias("state"), known.alias("known"), F.array_min(tried).alias("near")), lambda x: F.struct(
                F.when(x["near"].isNull(), rule.moved(x["state"], F.lit(block))).otherwise(rule.joined(x["state"], x["near"]["end"])).alias("state"),
                F.concat(a["met"], F.array(F.struct(b["block"].alias("block"), x["state"].alias("state"), x["known"].alias("known")))).alias("met")))
        return bind(rule.enter(a["state"], b["first"]), met)
    start = F.struct(rule.start.alias("state"), F.array().cast(met_type).alias("met"))
    return F.aggregate(chain, start, step, lambda a: a["met"])
