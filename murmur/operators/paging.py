"""Feeds and pages: every one is a top-k in an explicit total order."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from murmur import settings as S

NEWEST = ("timestamp", "mention_id")


def newest_first(*columns: str):
    return [F.col(c).desc_nulls_last() for c in columns]


def page(df: DataFrame, number: int = 1, limit: int = S.PAGE_SIZE, order=NEWEST) -> DataFrame:
    """Rows of one page, newest first. Far pages are cheaper by `page_after`."""
    if number < 1 or not 1 <= limit <= S.MAX_PAGE_SIZE:
        raise ValueError(f"page starts at 1, limit is 1..{S.MAX_PAGE_SIZE}")
    return df.orderBy(*newest_first(*order)).offset((number - 1) * limit).limit(limit)


def page_after(df: DataFrame, timestamp: str, mention_id: int, limit: int = S.PAGE_SIZE) -> DataFrame:
    """The page that follows a row, found by its key instead of by counting rows off."""
    ts, key = F.lit(timestamp).cast("timestamp"), F.col("mention_id")
    older = (F.col("timestamp") < ts) | ((F.col("timestamp") == ts) & (key < mention_id))
    return df.filter(older).orderBy(*newest_first(*NEWEST)).limit(limit)


def far_page(df: DataFrame, counts: DataFrame, number: int, limit: int = S.PAGE_SIZE, order=NEWEST) -> DataFrame:
    """Any page, newest first, for the price of a near one: only the minutes it lies in are read and ordered.

    `counts` has (minute, n), how many rows of `df` each minute has, for instance from a cube;
    the first column of `order` is the timestamp. Days are added up first, a row each, then
    the minutes of the days the page touches. Rows without a timestamp come last.
    """
    if number < 1 or not 1 <= limit <= S.MAX_PAGE_SIZE:
        raise ValueError(f"page starts at 1, limit is 1..{S.MAX_PAGE_SIZE}")
    first = (number - 1) * limit

    def reached(rows: DataFrame, at: str, since: int) -> DataFrame:
        """The rows of a running sum, newest first, that the page reaches, with what lies before each."""
        newest = W.orderBy(F.col(at).desc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
        summed = rows.withColumn("_end", F.sum("n").over(newest) + since)
        return summed.filter((F.col("_end") > first) & (F.col("_end") - F.col("n") < first + limit))
    days = counts.groupBy(F.to_date("minute").alias("day")).agg(F.sum("n").alias("n"))
    span = reached(days, "day", 0).agg(F.min("day").alias("low"), F.max("day").alias("high"), F.count("*").alias("days"),
                                       F.count("day").alias("dated"), F.min(F.col("_end") - F.col("n")).alias("before")).first()
    if not span["days"]:
        return df.limit(0)
    day = F.to_date("minute")
    inside = (day >= span["low"]) & (day <= span["high"]) if span["dated"] else F.lit(False)
    if span["dated"] < span["days"]:
        inside = inside | F.col("minute").isNull()
    minutes = reached(counts.groupBy("minute").agg(F.sum("n").alias("n")).filter(inside), "minute", span["before"])
    found = minutes.agg(F.min("minute").alias("low"), F.max("minute").alias("high"), F.count("*").alias("all"),
                        F.count("minute").alias("dated"), F.min(F.col("_end") - F.col("n")).alias("before")).first()
    stamp = F.col(order[0])
    wanted = (stamp >= found["low"]) & (stamp < found["high"] + timedelta(minutes=1)) if found["dated"] else F.lit(False)
    if found["dated"] < found["all"]:
        wanted = wanted | stamp.isNull()
    return df.filter(wanted).orderBy(*newest_first(*order)).offset(first - found["before"]).limit(limit)


def page_info(rows: DataFrame, available: DataFrame, number: int = 1,
              limit: int = S.PAGE_SIZE) -> DataFrame:
    """Totals of a feed: filtered rows, all rows, this page and the number of pages."""
    total = F.count("*")
    return rows.agg(
        total.alias("total"), F.lit(number).cast("bigint").alias("page"),
        F.greatest(F.lit(1).cast("bigint"), F.ceil(total / limit)).cast("bigint").alias("pages"),
    ).withColumn("available_total", available.agg(F.count("*")).scalar())


def latest(df: DataFrame, n: int, order=NEWEST) -> DataFrame:
    return df.orderBy(*newest_first(*order)).limit(n)


def latest_ascending(df: DataFrame, n: int = S.HISTORY_ROWS, order=NEWEST) -> DataFrame:
    return latest(df, n, order).orderBy(*order)


def audit_recent(audit: DataFrame, limit: int = 100) -> DataFrame:
    if not 1 <= limit <= 500:
        raise ValueError("limit is 1..500")
    return latest(audit, limit, ("id",))


def alerts_recent(alerts: DataFrame, limit: int = 100) -> DataFrame:
    return latest(alerts, limit, ("updated_at", "alert_id"))
