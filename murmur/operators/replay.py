"""Messages from a dataset: limits, repeats, injected spikes, bounded buffers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur import settings as S
from murmur.operators.filters import WHITE_SPACE


def limit_rows(df: DataFrame, n: int | None, order: str) -> DataFrame:
    """The first `n` rows by `order`; taken before blank texts are dropped."""
    return df if n is None else df.orderBy(order).limit(n)


def with_meta(messages: DataFrame, source: DataFrame, order: str) -> DataFrame:
    """Brand and username of each message by its text without outer white space, with defaults.

    A text met more than once takes its last row. The lookup goes by a digest of
    the text, so the source's texts are neither shuffled nor broadcast.
    """
    def trimmed(column: str) -> Column:
        return F.btrim(column, F.lit(WHITE_SPACE)).alias(column)

    def digest(column: str) -> Column:
        return F.sha2(trimmed(column), 256).alias("_digest")
    meta = source.groupBy(digest("tweet_text")).agg(
        F.max_by(F.struct(trimmed("brand"), trimmed("username")), order).alias("_m"))
    found = messages.withColumn("_digest", digest("tweet_text")).join(meta, "_digest", "left")
    return found.withColumn("brand", F.coalesce("_m.brand", F.lit(S.DEFAULT_BRAND))) \
                .withColumn("username", F.coalesce("_m.username", F.lit(S.DEFAULT_USER))) \
                .drop("_digest", "_m")


# The slowest and the fastest replay, in rows a second.
SLOWEST, FASTEST = 0.25, 8


def clock(spark) -> DataFrame:
    """A stream of FASTEST ticks a second, (timestamp, value)."""
    return spark.readStream.format("rate").option("rowsPerSecond", FASTEST).load()


def paced(ticks: DataFrame, speed: float) -> DataFrame:
    """Ticks of the clock thinned to `speed` a second and numbered anew from 0."""
    if not SLOWEST <= speed <= FASTEST:
        raise ValueError(f"speed is {SLOWEST}..{FASTEST}")
    share = speed / FASTEST
    number, after = F.floor(F.col("value") * share), F.floor((F.col("value") + 1) * share)
    return ticks.filter(after > number).withColumn("value", number)


def replay(ticks: DataFrame, source: DataFrame, n: int, total: int | None = None) -> DataFrame:
    """Repeat a dataset: tick i carries row i mod n, restamped with the tick's time.

    `ticks` is a stream or table of (value, timestamp) from `clock`, thinned by `paced` if it
    is to run slower; `source` has a `row_id` 0..n-1. `total` caps the rows sent over all repeats.
    """
    if total is not None:
        ticks = ticks.filter(F.col("value") < total)
    rows = source.withColumnRenamed("timestamp", "_stamp").drop("_stamp")
    return ticks.withColumn("row_id", F.col("value") % F.lit(n)).join(rows, "row_id")


# The row injected when no negative row exists.
DEMO_ROW = {"brand": "Demo brand", "tweet": "Service is broken and the experience is terrible",
            "username": S.DEFAULT_USER, "sentiment": "Negative", "polarity": -0.8,
            "subjectivity": 0.9, "confidence": 0.9}
SPIKE_PREFIX = "[DEMO SPIKE] "


def spike_rows(mentions: DataFrame, copies: int, at: Column, order: str = "mention_id") -> DataFrame:
    """`copies` negative rows at one moment; their union with `mentions` back-tests the detector.

    The i-th copy is the i-th negative row by `order`, starting over when they run out.
    """
    spark = mentions.sparkSession
    # As many rows as copies at most, so they may come to the driver.
    negatives = mentions.filter(F.col("sentiment") == "Negative").orderBy(order).limit(copies).collect()
    n = max(1, len(negatives))
    if negatives:
        schema = T.StructType([*mentions.schema.fields, T.StructField("row_id", T.IntegerType())])
        seeds = spark.createDataFrame([(*row, i) for i, row in enumerate(negatives)], schema)
    else:
        fixed = [F.lit(DEMO_ROW.get(f.name)).cast(f.dataType).alias(f.name) for f in mentions.schema]
        seeds = spark.range(1).select(*fixed, F.lit(0).alias("row_id"))
    ticks = spark.range(copies).select(F.col("id").alias("value"), at.alias("timestamp"))
    rows = replay(ticks, seeds, n)
    if "tweet" in mentions.columns:
        rows = rows.withColumn("tweet", F.concat(F.lit(SPIKE_PREFIX), F.col("tweet")))
    return rows.select("value", *mentions.columns)


def spike_alerts(spike: DataFrame) -> DataFrame:
    """The alert raised with each injected row."""
    return spike.select(
        F.concat(F.lit("demo-"), (F.col("value") + 1).cast("string")).alias("id"),
        F.concat(F.lit(S.DEMO_TITLE), "brand").alias("title"),
        F.lit(S.DEMO_REASON).alias("detail"),
        F.lit("High").alias("severity"), F.lit("Open").alias("status"))


def retained_rows(appended: int, cap: int = S.BUFFER_ROWS, trim: int = S.BUFFER_TRIM) -> int:
    """Rows left after `appended` appends to a buffer that drops its oldest `trim` when it passes `cap`."""
    if appended <= cap:
        return appended
    return cap + 1 - trim + (appended - cap - 1) % trim


def retain_latest(df: DataFrame, order: str, cap: int = S.BUFFER_ROWS, trim: int = S.BUFFER_TRIM) -> DataFrame:
    """The rows such a buffer holds after all of `df` was appended in `order`."""
    return df.orderBy(F.desc(order)).limit(retained_rows(df.count(), cap, trim))
