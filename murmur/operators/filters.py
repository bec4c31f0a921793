"""Row filters of the feed and the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import settings as S

# The spans of the day filter, the characters that count as blank.
DAY_SPANS = (7, 30, 90)
WHITE_SPACE = ("\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _same_text(column: str, wanted: str) -> Column:
    if wanted.lower() == "all":
        return F.lit(True)
    return F.lower(column) == F.lower(F.lit(wanted))


def is_brand(brand: str = "all") -> Column:
    return _same_text("brand", brand)


def is_sentiment(sentiment: str = "all") -> Column:
    return _same_text("sentiment", sentiment)


def holds(text: Column, needle: str) -> Column:
    """Case-insensitive substring test; wildcard characters have no meaning."""
    return F.contains(F.lower(text), F.lower(F.lit(needle)))


def found_in(needle: str, tweet: Column | None = None) -> Column:
    if not needle:
        return F.lit(True)
    return holds(F.col("tweet") if tweet is None else tweet, needle) | holds(F.col("brand"), needle)


def last_days(df: DataFrame, days: int | str) -> DataFrame:
    """Rows at most `days` days older than the newest row of `df`; other spans keep all.

    Rows without a timestamp go, unless no row has one: then all stay.
    """
    if str(days) not in {str(d) for d in DAY_SPANS}:
        return df
    newest = df.select(F.max("timestamp")).scalar()
    cutoff = newest - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(newest.isNull() | (F.col("timestamp") >= cutoff))


def filtered(df: DataFrame, brand: str = "all", sentiment: str = "all", search: str = "",
             days: int | str = "all") -> DataFrame:
    """All filters; the day span counts back from the newest row the others keep."""
    return last_days(df.filter(is_brand(brand) & is_sentiment(sentiment) & found_in(search)), days)


def drop_bad_timestamp(df: DataFrame) -> DataFrame:
    return df.filter(F.col("timestamp").isNotNull())


def drop_blank_text(df: DataFrame, column: str = "tweet") -> DataFrame:
    """Trimmed text; rows where nothing is left go."""
    return df.withColumn(column, F.btrim(column, F.lit(WHITE_SPACE))).filter(F.col(column) != "")


def slicer(df: DataFrame, sentiments: list[str] | None = None, brands: list[str] | None = None,
           start: str | None = None, end: str | None = None, keyword: str = "") -> DataFrame:
    """Report slicers: chosen values, an inclusive time range, a keyword of clean_tweet."""
    if sentiments:
        df = df.filter(F.col("sentiment").isin(sentiments))
    if brands:
        df = df.filter(F.col("brand").isin(brands))
    if start and end:
        df = df.filter(F.col("timestamp").between(F.lit(start).cast("timestamp"),
                                                  F.lit(end).cast("timestamp")))
    return df.filter(holds(F.col("clean_tweet"), keyword)) if keyword else df


def slicer_values(df: DataFrame) -> DataFrame:
    """The values the sentiment and brand slicers offer."""
    pairs = df.select(F.explode(F.array(
        F.struct(F.lit("brand").alias("slicer"), F.col("brand").alias("value")),
        F.struct(F.lit("sentiment").alias("slicer"), F.col("sentiment").alias("value")))).alias("v"))
    return pairs.select("v.*").distinct()


def brands_list(df: DataFrame) -> DataFrame:
    return df.filter(F.col("brand") != S.DEFAULT_BRAND).select("brand").distinct().orderBy("brand")
