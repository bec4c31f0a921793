"""Ordered look-back over a whole table without one task that sorts it all.

A position (a second, or the rank of a window) is cut into blocks. What a block's
look-back reaches is copied into it from the block before, so each block is
answered alone and exactly. Callers aggregate to one row per key and position
first: a block then holds at most `block + lookback` rows of a key, however many
raw rows the key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _with_copies(df: DataFrame, pos: str, lookback: int, block: int) -> tuple[DataFrame, Column]:
    """Rows under their block, and again under the next one if its look-back reaches them."""
    home = F.floor(F.col(pos) / block)
    reaches_next = F.col(pos) % block >= block - lookback
    return df.withColumn("_block", F.explode(
        F.when(reaches_next, F.array(home, home + 1)).otherwise(F.array(home)))), home


def look_back(df: DataFrame, keys: list[str], pos: str, lookback: int, aggs: dict[str, Column],
              block: int = 3600) -> DataFrame:
    """Add `aggs` over the rows of the same keys at positions [pos - lookback, pos - 1].

    Any aggregate; each row reads its frame again, so this is for short look-backs.
    """
    copies, home = _with_copies(df, pos, lookback, max(block, lookback))
    frame = W.partitionBy(*keys, "_block").orderBy(pos).rangeBetween(-lookback, -1)
    return (copies.select("*", *[a.over(frame).alias(n) for n, a in aggs.items()])
            .filter(F.col("_block") == home).drop("_block"))


def last_seen(df: DataFrame, keys: list[str], pos: str, lookback: int, flag: Column, name: str,
              strict: bool = False, block: int = 3600) -> DataFrame:
    """Add the latest flagged position at most `lookback` before each row, the row's own unless `strict`."""
    copies, home = _with_copies(df, pos, lookback, max(block, lookback))
    frame = W.partitionBy(*keys, "_block").orderBy(pos).rowsBetween(W.unboundedPreceding, -1 if strict else 0)
    marked = copies.withColumn("_last", F.max(F.when(flag, F.col(pos))).over(frame))
    near = F.when(F.col(pos) - F.col("_last") <= lookback, F.col("_last"))
    return marked.filter(F.col("_block") == home).withColumn(name, near).drop("_block", "_last")


def sliding_sum(df: DataFrame, keys: list[str], pos: str, lookback: int, values: dict[str, Column],
                block: int = 3600) -> DataFrame:
    """Add sums of whole numbers over the rows of the same keys at positions [pos - lookback, pos].

    Each value enters a running sum at its position and leaves it when the span has
    passed, so the cost does not grow with the span. A value that leaves in the next
    block enters that block at its start.
    """
    block = max(block, lookback + 1)
    at = F.col(pos).cast("bigint")
    home, leaves = F.floor(at / block), at + (lookback + 1)

    def entry(in_block: Column, position: Column, sign: int, row: bool) -> Column:
        return F.struct(in_block.alias("_block"), position.alias("_at"), F.lit(sign).alias("_sign"),
                        F.lit(row).alias("_row"))
    own = entry(home, at, 1, True)
    entries = F.when(F.floor(leaves / block) == home, F.array(own, entry(home, leaves, -1, False))).otherwise(
        F.array(own, entry(home + 1, (home + 1) * block, 1, False), entry(home + 1, leaves, -1, False)))
    so_far = W.partitionBy(*keys, "_block").orderBy("_at").rangeBetween(W.unboundedPreceding, W.currentRow)
    moved = df.select("*", F.inline(entries))
    sums = [F.sum(v * F.col("_sign")).over(so_far).alias(n) for n, v in values.items()]
    return moved.select("*", *sums).filter("_row").drop("_block", "_at", "_sign", "_row")


def dense_rank(df: DataFrame, pos: str, rank: str = "rank", blocks: int = 200) -> DataFrame:
    """Number the rows 1..n by `pos`, a whole number that no two rows share.

    The span is cut at approximate quantiles of `pos`, so `blocks` tasks get about as many
    rows each, however dense or sparse the numbers are; only the blocks' counts, one row
    each, pass through a single task. `df` is read three times.
    """
    shares = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
    cuts = df.agg(F.percentile_approx(F.col(pos).cast("bigint"), shares, 20 * blocks)).scalar()
    ranged = df.withColumn("_cuts", cuts).withColumn(
        "_block", F.size(F.filter("_cuts", lambda c: c < F.col(pos)))).drop("_cuts")
    offsets = (ranged.groupBy("_block").agg(F.count("*").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(
                   W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
               .drop("_n"))
    within = F.row_number().over(W.partitionBy("_block").orderBy(pos))
    # At most one row for each block.
    return (ranged.join(F.broadcast(offsets), "_block").withColumn(rank, F.col("_before") + within)
            .drop("_block", "_before"))


def calendar_rank(df: DataFrame, pos: str, rank: str = "rank", block: int = 3600) -> DataFrame:
    """Number the rows 1..n by `pos`, the number of a time window, that no two rows share.

    Blocks of `block` windows are counted first. Their number is bounded by the span of time,
    not by the rows: ten years of minutes are 1,500 blocks.
    """
    blocks = df.withColumn("_block", F.floor(F.col(pos) / block))
    offsets = (blocks.groupBy("_block").agg(F.count("*").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(
                   W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
               .drop("_n"))
    within = F.row_number().over(W.partitionBy("_block").orderBy(pos))
    return (blocks.join(offsets, "_block").withColumn(rank, F.col("_before") + within)
            .drop("_block", "_before"))


def running_max(df: DataFrame, keys: list[str], pos: str, value: Column, name: str,
                block: int = 3600) -> DataFrame:
    """Add the largest `value` at or before each position of the same keys.

    Each block runs alone on top of the maximum of the blocks before it; only the
    block maxima of a key, one row per block, pass through a task together.
    """
    rows = df.withColumn("_block", F.floor(F.col(pos) / block)).withColumn("_value", value)
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = (rows.groupBy(*keys, "_block").agg(F.max("_value").alias("_top"))
               .withColumn("_carried", F.max("_top").over(before)).drop("_top"))
    within = W.partitionBy(*keys, "_block").orderBy(pos).rowsBetween(W.unboundedPreceding, 0)
    return (rows.join(carried, [*keys, "_block"])
            .withColumn(name, F.greatest(F.max("_value").over(within), F.col("_carried")))
            .drop("_block", "_value", "_carried"))
