"""Key figures, breakdowns and time series.

Every group-by here has a partial aggregate before its shuffle, so a brand or a
minute that holds a third of all rows costs its reducer one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.fixed import mean, mean_of_micro, percent, plain, ratio, to_micro
from murmur.functions.sentiment import bucket_order, polarity_bucket, score_0_100
from murmur.operators.spans import sliding_sum
from murmur.operators.windows import minute_grid


def _count_of(label: str) -> Column:
    return F.count_if(F.col("sentiment") == label)


def label_counts() -> list[Column]:
    return [_count_of(label).alias(label.lower()) for label in S.LABELS]


def kpi_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *label_counts())


def kpi_shares(counts: DataFrame) -> DataFrame:
    """Percentages, fractions and labels from `kpi_counts`; all 0 when there is no row."""
    total = F.col("total")
    shares = []
    for name in ("positive", "negative", "neutral"):
        shares += [percent(F.col(name), total).alias(f"{name}_pct"),
                   F.coalesce(F.try_divide(F.col(name).cast("double"), total.cast("double")),
                              F.lit(0.0)).alias(f"{name}_share")]
    out = counts.select("*", *shares)
    for name in ("positive", "negative"):
        out = out.withColumn(f"{name}_label", F.concat(plain(F.round(F.col(f"{name}_share") * 100, 1), 1),
                                                       F.lit("%")))
    return out


def neutral_remainder(shares: DataFrame) -> DataFrame:
    rest = F.greatest(F.lit(0.0), F.round(100 - F.col("positive_pct") - F.col("negative_pct"), 1))
    return shares.withColumn("neutral_rest_pct", rest)


def avg_scores(df: DataFrame) -> DataFrame:
    return df.agg(mean(F.col("polarity"), 3).alias("avg_polarity"),
                  mean(F.col("subjectivity"), 6).alias("avg_subjectivity"),
                  mean(F.col("confidence"), 6).alias("avg_confidence"))


def sentiment_score(df: DataFrame) -> DataFrame:
    return df.agg(score_0_100(mean(F.col("polarity"), 6)).alias("sentiment_score"))


def tweets_per_min(df: DataFrame, minutes: int = 30) -> DataFrame:
    """Rows per minute of a fixed span, and of the span the rows cover."""
    span = F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))
    return df.agg(F.count("*").alias("total"), span.alias("seconds")).select(
        "total", ratio(F.col("total"), F.lit(minutes), 1).alias("tweets_per_min"),
        ratio(F.col("total") * 60, F.col("seconds"), 1).alias("observed_per_min"))


def by_brand(df: DataFrame) -> DataFrame:
    """Per brand: rows, mean polarity and percent negative, largest brand first."""
    return (df.groupBy("brand")
            .agg(F.count("*").alias("total"), mean(F.col("polarity"), 3).alias("polarity"),
                 percent(_count_of("Negative"), F.count("*"), 0).alias("negative"))
            .withColumn("negative", F.col("negative").cast("bigint"))
            .orderBy(F.desc("total"), "brand"))


def brand_measures(df: DataFrame) -> DataFrame:
    """Per brand: positive share and net sentiment, both as fractions."""
    counts = df.groupBy("brand").agg(F.count("*").alias("total"), *label_counts())
    return counts.select(
        "brand", (F.col("positive") / F.col("total")).alias("positive_share"),
        ((F.col("positive") - F.col("negative")) / F.col("total")).alias("net_sentiment"))


def brand_sentiment_mix(df: DataFrame) -> DataFrame:
    return df.groupBy("brand").agg(*label_counts())


def sentiment_distribution(df: DataFrame) -> DataFrame:
    """The three labels in fixed order with count and percent; absent labels count 0."""
    domain = df.sparkSession.createDataFrame(
        [(i, label) for i, label in enumerate(S.LABELS, 1)], "position INT, sentiment STRING")
    counts = df.groupBy("sentiment").agg(F.count("*").alias("n"))
    rows = domain.join(counts, "sentiment", "left").fillna(0, ["n"])
    return rows.select("position", "sentiment", "n",
                       percent(F.col("n"), F.sum("n").over(W.partitionBy())).alias("pct")).orderBy("position")


def sentiment_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("sentiment").agg(
        F.count("*").alias("total"), mean(F.col("polarity"), 3).alias("avg_polarity"),
        percent(_count_of("Positive"), F.count("*")).alias("positive_pct"),
        percent(_count_of("Negative"), F.count("*")).alias("negative_pct"))


def bucket_histogram(df: DataFrame) -> DataFrame:
    return (df.groupBy(bucket_order(F.col("polarity")).alias("position"),
                       polarity_bucket(F.col("polarity")).alias("polarity_bucket"))
            .agg(F.count("*").alias("n")).orderBy("position"))


def scatter_points(df: DataFrame) -> DataFrame:
    """Distinct points per sentiment with the number of rows on each."""
    return df.groupBy("sentiment", "polarity", "subjectivity", "confidence").agg(F.count("*").alias("n"))


def word_frequency(df: DataFrame, top: int = S.TOP_WORDS) -> DataFrame:
    words = df.select(F.explode(F.split("clean_tweet", " ")).alias("word")).filter("word <> ''")
    return count_words(words, top)


def count_words(words: DataFrame, top: int = S.TOP_WORDS) -> DataFrame:
    """The most frequent words of (word, n) rows; ties in alphabetical order."""
    return words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(top)


def timeline_minute_of_day(df: DataFrame) -> DataFrame:
    """Counts and mean polarity per HH:mm, all days folded together; no timestamp is '—'."""
    key = F.coalesce(F.date_format("timestamp", "HH:mm"), F.lit("—"))
    return (df.groupBy(key.alias("time"))
            .agg(*label_counts(), mean(F.col("polarity"), 3).alias("polarity")).orderBy("time"))


def resample_minute(df: DataFrame, seconds: int = 60) -> DataFrame:
    """Volume and mean polarity of every minute of the span; empty ones have 0 and null."""
    seen = (df.filter("timestamp IS NOT NULL")
            .groupBy(F.window("timestamp", f"{seconds} seconds").alias("w"))
            .agg(F.count("sentiment").alias("volume"), mean(F.col("polarity"), 6).alias("avg_polarity"))
            .select(F.col("w.start").alias("minute"), "volume", "avg_polarity"))
    return minute_grid(seen, "minute", seconds).join(seen, "minute", "left").fillna(0, ["volume"])


def trend_by_sentiment(df: DataFrame, seconds: int = 3600) -> DataFrame:
    return (df.groupBy(F.window("timestamp", f"{seconds} seconds").alias("w"), "sentiment")
            .agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "sentiment", "n"))


def score_trend(df: DataFrame) -> DataFrame:
    """Mean polarity and subjectivity at each distinct timestamp."""
    return df.groupBy("timestamp").agg(mean(F.col("polarity"), 6).alias("avg_polarity"),
                                       mean(F.col("subjectivity"), 6).alias("avg_subjectivity"))


def report_summary(df: DataFrame) -> DataFrame:
    """Metric and value rows of the report; the value is text."""
    figures = df.agg(F.count("*").alias("n"), *label_counts(),
                     F.coalesce(mean(F.col("polarity"), 3), F.lit(0.0)).alias("polarity"),
                     F.coalesce(F.sum(to_micro(F.col("polarity"))), F.lit(0)).alias("micro"))
    return figures.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("metric"), value.alias("value"))
        for i, (name, value) in enumerate((
            ("Mentions", F.col("n").cast("string")), ("Positive", F.col("positive").cast("string")),
            ("Neutral", F.col("neutral").cast("string")), ("Negative", F.col("negative").cast("string")),
            ("Average polarity", plain(F.col("polarity"), 3, F.col("micro")))), 1)])))


def _newest(df: DataFrame, span: str) -> DataFrame:
    newest = df.select(F.max("timestamp")).scalar()
    return df.filter(F.col("timestamp") >= newest - F.expr(f"INTERVAL {span}"))


def latest_window_count(df: DataFrame, seconds: int = 30) -> DataFrame:
    return _newest(df, f"{seconds} SECONDS").agg(F.count("*").alias("n"))


def latest_avg_polarity(df: DataFrame, minutes: int = 5) -> DataFrame:
    return _newest(df, f"{minutes} MINUTES").agg(mean(F.col("polarity"), 6).alias("rolling_avg_polarity"))


def rolling_avg_polarity(df: DataFrame, seconds: int = 300) -> DataFrame:
    """At each second that has rows, the mean polarity of the `seconds` up to it.

    Rows of one second are peers, so they are summed first; the look-back then
    moves over at most one row per second.
    """
    per_second = (df.filter("timestamp IS NOT NULL").groupBy(F.unix_timestamp("timestamp").alias("second"))
                  .agg(F.sum(to_micro(F.col("polarity"))).alias("micro"), F.count("*").alias("n")))
    rolled = sliding_sum(per_second, [], "second", seconds, {"_micro": F.col("micro"), "_n": F.col("n")},
                         block=14_400)
    return rolled.select(F.timestamp_seconds("second").alias("second"), F.col("_n").alias("n"),
                         mean_of_micro(F.col("_micro"), F.col("_n"), 6).alias("rolling_avg_polarity"))


def brand_bars(brands: DataFrame, top: int = S.TOP_BRANDS) -> DataFrame:
    """The largest brands of `by_brand` with a bar width in percent of the strongest polarity."""
    first = brands.orderBy(F.desc("total"), "brand").limit(top)
    strongest = F.greatest(F.lit(0.1), F.max(F.abs("polarity")).over(W.partitionBy()))
    width = F.greatest(F.lit(5.0), F.abs("polarity") / strongest * 100)
    return first.withColumn("width", width)
