"""Isolation forest over window metrics (Liu, Ting, Zhou 2008), for the latest window or for each.

A window is scored by a forest fitted on the windows before it. All that is drawn comes
from digests: a tree's sample of the first p windows is those of the smallest digests of
(seed, tree, rank), so it changes by single windows as p grows, and a node's feature and cut
come from (seed, tree, node). A score depends on nothing else, so a repeated task, another
engine or a later run gives the same. Of a tree only the path of the scored window is grown.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.display import iso_utc
from murmur.operators.spans import calendar_rank

FEATURES = ["volume", "mean_polarity", "negative_ratio"]
#: Bits of a digest that count.
BITS = 52


def average_path(size):
    """Expected depth of an unsuccessful search in a random tree of `size` points."""
    n = np.asarray(size, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def digest(*parts) -> int:
    """The first 52 bits of the digest of the parts, joined by colons."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:BITS // 4], 16)


def sampled(windows: DataFrame, n: int, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, rank, until): the windows 1..n that are ever among the `sample` smallest digests of a prefix.

    A window enters with its own rank and is out from the prefix `until` on. A tree needs
    nothing of the windows but their number; it keeps `sample` digests and yields, as
    digests are drawn evenly, about sample x (1 + ln(n / sample)) rows.
    """
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tree in (int(t) for pdf in batches for t in pdf["tree"]):
            held: list[tuple[int, int]] = []  # the largest digest first
            rows = []
            for rank in range(1, n + 1):
                entry = (-digest(seed, tree, rank), -rank)
                if len(held) < sample:
                    heappush(held, entry)
                elif entry > held[0]:
                    rows.append((tree, -heappushpop(held, entry)[1], rank))
            rows += [(tree, -rank, n + 1) for _, rank in held]
            yield pd.DataFrame(rows, columns=["tree", "rank", "until"])
    spark = windows.sparkSession
    parts = min(trees, spark.sparkContext.defaultParallelism)
    return spark.range(0, trees, 1, parts).select(F.col("id").cast("int").alias("tree")).mapInPandas(draw, "tree INT, rank BIGINT, until BIGINT")


class Forest:
    """The windows any tree ever samples, and each node's draws."""

    def __init__(self, points: pd.DataFrame, trees: int, sample: int, seed: int):
        points = points.sort_values(["tree", "rank"])
        counts = np.bincount(points["tree"], minlength=trees)
        place = (points["tree"].to_numpy(), np.arange(len(points)) - np.repeat(np.cumsum(counts) - counts, counts))
        shape = (trees, int(counts.max()))
        self.rank, self.until = np.full(shape, np.iinfo(np.int64).max), np.zeros(shape, np.int64)
        self.values = np.zeros((*shape, len(FEATURES)))
        self.rank[place], self.until[place] = points["rank"], points["until"]
        self.values[place] = points[FEATURES].to_numpy(float)
        depth = math.ceil(math.log2(max(2, sample)))
        draws = [[[digest(seed, t, node, what) / 2 ** BITS for node in range(1 << depth)] for t in range(trees)] for what in "fc"]
        self.choice, self.cut = np.array(draws)
        self.trees, self.sample = trees, sample

    def score(self, rank: int, point: np.ndarray) -> float:
        """2^(-mean depth / expected depth) - 0.5 of a window by the windows before it, along its path in all trees at a time."""
        size = min(self.sample, rank - 1)
        inside = (self.rank < rank) & (self.until >= rank)
        points = self.values[inside].reshape(self.trees, size, len(FEATURES))
        here = np.ones((self.trees, size), bool)
        node, depth, every = np.ones(self.trees, int), np.zeros(self.trees), np.arange(self.trees)
        growing = np.ones(self.trees, bool)
        for _ in range(math.ceil(math.log2(max(2, size)))):
            low = np.where(here[:, :, None], points, np.inf).min(1)
            high = np.where(here[:, :, None], points, -np.inf).max(1)
            usable = high > low
            n = usable.sum(1)
            growing &= (n > 0) & (here.sum(1) > 1)
            if not growing.any():
                break
            nth = np.floor(self.choice[every, node] * n)
            feature = (usable & (np.cumsum(usable, 1) - 1 == nth[:, None])).argmax(1)
            lowest = low[every, feature]
            cut = lowest + self.cut[every, node] * (high[every, feature] - lowest)
            left = point[feature] <= cut
            side = (points[every, :, feature] <= cut[:, None]) == left[:, None]
            here = np.where(growing[:, None], here & side, here)
            node = np.where(growing, 2 * node + ~left, node)
            depth = depth + growing
        path = float((depth + average_path(here.sum(1))).sum())
        return float(np.exp2(-path / self.trees / float(average_path(size))) - 0.5)


def ranked_windows(metrics: DataFrame, seconds: int) -> DataFrame:
    position = F.floor(F.unix_timestamp("window_start") / seconds)
    return calendar_rank(metrics.select("window_start", *FEATURES).withColumn("_pos", position), "_pos").drop("_pos")


def isolation_scores(metrics: DataFrame, seconds: int = S.WINDOW_SECONDS, latest: bool = False, trees: int = S.FOREST_TREES,
                     sample: int = S.FOREST_SAMPLE, seed: int = S.FOREST_SEED, only: DataFrame | None = None) -> DataFrame:
    """Windows with their rank and isolation_score by the windows before them.

    All windows, only the last one if `latest`, or those of column window_start in `only`.

    With fewer than FOREST_MIN_WINDOWS windows up to it, itself included, a window's score is
    0. What travels to the scoring tasks are the windows that any tree ever samples: for the
    latest window trees x sample of them at most, for all a logarithm of their number times as
    many. The metrics are read several times: settle the facts they come from.
    """
    ranked = ranked_windows(metrics, seconds)
    n = ranked.agg(F.coalesce(F.max("rank"), F.lit(0))).first()[0]
    wanted = ranked.filter(F.col("rank") == n) if latest else ranked if only is None else ranked.join(only, "window_start", "left_semi")
    if n < S.FOREST_MIN_WINDOWS:
        return wanted.withColumn("isolation_score", F.lit(0.0))
    picks = sampled(metrics, n - 1, trees, sample, seed)
    if latest:
        picks = picks.filter(F.col("until") == n)
    points = picks.join(ranked, "rank").select("tree", "rank", "until", *FEATURES).toPandas()
    forest = metrics.sparkSession.sparkContext.broadcast(Forest(points, trees, sample, seed))

    @F.pandas_udf("double")
    def score(rank: pd.Series, volume: pd.Series, polarity: pd.Series, negative: pd.Series) -> pd.Series:
        points = np.column_stack([volume, polarity, negative]).astype(float)
        return pd.Series([forest.value.score(r, p) if r >= S.FOREST_MIN_WINDOWS else 0.0 for r, p in zip(rank.tolist(), points)], dtype=float)
    return wanted.withColumn("isolation_score", score("rank", *FEATURES))


def latest_isolation(metrics: DataFrame, seconds: int = S.WINDOW_SECONDS, **forest) -> DataFrame:
    """The latest window with its score by a forest fitted on all windows before it; see `isolation_scores`."""
    return isolation_scores(metrics, seconds, True, **forest)


def isolation_alerts(scored: DataFrame) -> DataFrame:
    start = iso_utc(F.col("window_start"))
    return scored.filter(F.col("isolation_score") >= S.FOREST_ALERT).select(
        F.concat(F.lit("window-isolation-"), start).alias("id"),
        F.lit(S.FOREST_TITLE).alias("title"), F.lit("Medium").alias("severity"),
        F.lit(S.FOREST_REASON).alias("reason"),
        F.bround(F.least(F.col("isolation_score"), F.lit(1.0)), 3).alias("score"),
        F.lit("multivariate").alias("metric"), F.lit(None).cast("string").alias("brand"),
        start.alias("window"))
