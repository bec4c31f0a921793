"""Sums by minute, brand and sentiment that the dashboard's parts are all made of.

A cube has a row for each minute, brand and label that occurs, however many mentions there
are. Its sums are whole numbers, so cubes of batches add up to the cube of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.fixed import mean_of_micro, percent, ratio, to_micro
from murmur.operators.aggregates import kpi_shares

AXES = ["minute", "brand", "sentiment"]
SCORES = ("polarity", "subjectivity", "confidence")
SUMS = ["n", *[f"{s}_{part}" for s in SCORES for part in ("micro", "n")]]
CUBE = "minute TIMESTAMP, brand STRING, sentiment STRING, " + ", ".join(f"{c} BIGINT" for c in SUMS)


def cube(mentions: DataFrame) -> DataFrame:
    """The cube of mentions; those without a timestamp have a null minute, and scores that are missing are no sums."""
    present = [s for s in SCORES if s in mentions.columns]
    sums = {f"{s}_{part}": c for s in present for part, c in (("micro", F.sum(to_micro(F.col(s)))), ("n", F.count(s)))}
    none = F.lit(None).cast("bigint")
    return (mentions.groupBy(F.date_trunc("minute", "timestamp").alias("minute"), "brand", "sentiment")
            .agg(F.count("*").alias("n"), *[c.alias(name) for name, c in sums.items()])
            .select(*AXES, *[F.col(c) if c == "n" or c in sums else none.alias(c) for c in SUMS]))


def merged(*cubes: DataFrame) -> DataFrame:
    """One cube of several, for instance of a table's and a batch's."""
    rows = cubes[0]
    for more in cubes[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*AXES).agg(*[F.sum(c).alias(c) for c in SUMS])


def _of(label: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("sentiment") == label, F.col("n"))), F.lit(0))


def _counts() -> list[Column]:
    return [_of(label).alias(label.lower()) for label in S.LABELS]


def _mean(score: str, places: int) -> Column:
    return mean_of_micro(F.sum(f"{score}_micro"), F.coalesce(F.sum(f"{score}_n"), F.lit(0)), places)


def figures(rows: DataFrame) -> DataFrame:
    """Totals, shares, mean polarity and mentions a minute of the half hour shown."""
    total = F.coalesce(F.sum("n"), F.lit(0))
    return kpi_shares(rows.agg(total.alias("total"), *_counts(), _mean("polarity", 3).alias("avg_polarity"))).withColumn(
        "tweets_per_min", ratio(F.col("total"), F.lit(30), 1))


def by_brand(rows: DataFrame) -> DataFrame:
    """Per brand: rows, mean polarity and percent negative, largest brand first."""
    return (rows.groupBy("brand").agg(F.sum("n").alias("total"), _mean("polarity", 3).alias("polarity"),
                                      percent(_of("Negative"), F.sum("n"), 0).cast("bigint").alias("negative"))
            .orderBy(F.desc("total"), "brand"))


def timeline_minute_of_day(rows: DataFrame) -> DataFrame:
    """Counts and mean polarity per HH:mm, all days folded together; no timestamp is '—'."""
    key = F.coalesce(F.date_format("minute", "HH:mm"), F.lit("—"))
    return rows.groupBy(key.alias("time")).agg(*_counts(), _mean("polarity", 3).alias("polarity")).orderBy("time")


def window_facts(rows: DataFrame, seconds: int) -> DataFrame:
    """The detector's facts; its windows are whole minutes."""
    if seconds % 60:
        raise ValueError("a cube holds whole minutes")
    dated = rows.filter("minute IS NOT NULL").groupBy(F.window("minute", f"{seconds} seconds").alias("w"), "brand")
    return dated.agg(F.sum("n").alias("mentions"), _of("Negative").alias("negatives"), F.sum("polarity_micro").alias("polarity_micro")) \
                .select(F.col("w.start").alias("window_start"), "brand", "mentions", "negatives", "polarity_micro")
