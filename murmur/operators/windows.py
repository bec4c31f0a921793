"""Tumbling window metrics and the trailing-baseline detector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.display import iso_utc
from murmur.functions.fixed import mean_of_micro, plain, to_micro
from murmur.operators.spans import calendar_rank, look_back
def window_facts(mentions: DataFrame, seconds: int = S.WINDOW_SECONDS) -> DataFrame:
    """Per window and brand: mentions, negatives and the polarity sum in millionths.

    The one pass over raw rows; everything below works on its result. Rows without
    a timestamp belong to no window.
    """
    return (mentions.filter(F.col("timestamp").isNotNull())
            .groupBy(F.window("timestamp", f"{seconds} seconds").alias("w"), "brand")
            .agg(F.count("*").alias("mentions"),
                 F.count_if(F.col("sentiment") == "Negative").alias("negatives"),
                 F.sum(to_micro(F.col("polarity"))).alias("polarity_micro"))
            .select(F.col("w.start").alias("window_start"), "brand",
                    "mentions", "negatives", "polarity_micro"))


def window_metrics(facts: DataFrame) -> DataFrame:
    """Per non-empty window: volume, mean polarity and share of negatives."""
    return (facts.groupBy("window_start")
            .agg(F.sum("mentions").alias("volume"), F.sum("negatives").alias("negatives"),
                 F.sum("polarity_micro").alias("polarity_micro"))
            .select("window_start", "volume",
                    mean_of_micro(F.col("polarity_micro"), F.col("volume"), 6).alias("mean_polarity"),
                    (F.col("negatives") / F.col("volume")).alias("negative_ratio")))


def tumbling_metrics(facts: DataFrame) -> DataFrame:
    """Window metrics with the brand -> mentions map of each window."""
    # The result's one cell for a window holds its brands, as many as are mentioned in one window.
    brands = facts.groupBy("window_start").agg(
        F.map_from_entries(F.collect_list(F.struct("brand", "mentions"))).alias("brands"))
    return window_metrics(facts).join(brands, "window_start")


def flat_or_z(value: Column, mean: Column, sd: Column, n: Column) -> Column:
    """z of a value against its baseline; a flat baseline gives 0 or the fixed high value."""
    flat = F.when(F.abs(value - mean) < 1e-9, 0.0).otherwise(S.FLAT_BASELINE_Z)
    return (F.when(F.coalesce(n, F.lit(0)) < S.MIN_BASELINE, 0.0)
            .when(sd < 1e-9, flat).otherwise((value - mean) / sd))


def exact_z(value: Column, n: Column, total: Column, squares: Column) -> Column:
    """The same z for whole numbers, from the count, sum and sum of squares of the baseline.

    Zero counts need no rows: they add to `n` only.
    """
    spread = n * squares - total * total
    gap = n * value - total
    flat = F.when(gap == 0, 0.0).otherwise(S.FLAT_BASELINE_Z)
    return (F.when(n < S.MIN_BASELINE, 0.0)
            .when(spread == 0, flat).otherwise(gap / F.sqrt(spread.cast("double"))))


def gap_fill(metrics: DataFrame, seconds: int) -> DataFrame:
    """Add the empty windows between the first and the last one, with volume 0."""
    return minute_grid(metrics, "window_start", seconds).join(metrics, "window_start", "left") \
        .fillna(0, ["volume"]).fillna(0.0, ["negative_ratio", "mean_polarity"])


def minute_grid(df: DataFrame, column: str, seconds: int, per_task: int = 3600) -> DataFrame:
    """Every window start from the first to the last value of `column`.

    The span is cut into runs of `per_task` windows that tasks fill in parallel.
    """
    bounds = df.select(F.unix_timestamp(F.min(column)).alias("lo"),
                       F.unix_timestamp(F.max(column)).alias("hi")).filter("lo IS NOT NULL")
    run = per_task * seconds
    starts = bounds.select("hi", F.explode(F.sequence("lo", "hi", F.lit(run).cast("bigint"))).alias("lo"))
    stop = F.least(F.col("hi"), F.col("lo") + (run - seconds))
    return (starts.repartition("lo")
            .select(F.explode(F.sequence(F.col("lo"), stop, F.lit(seconds).cast("bigint"))).alias("s"))
            .select(F.timestamp_seconds("s").alias(column)))


def scored_windows(metrics: DataFrame, seconds: int = S.WINDOW_SECONDS,
                   history: int = S.HISTORY_WINDOWS) -> DataFrame:
    """Each window with its rank, baseline size and the z of volume and of negative share.

    The baseline is the `history` non-empty windows before it, the window itself
    excluded; a quiet stretch is skipped, not counted as zero (see `gap_fill`).
    """
    ranked = calendar_rank(metrics.withColumn("_pos", F.floor(F.unix_timestamp("window_start") / seconds)),
                           "_pos")
    volume, share = F.col("volume"), F.col("negative_ratio")
    based = look_back(ranked, [], "rank", history, {
        "n": F.count("*"), "_total": F.sum(volume), "_squares": F.sum(volume * volume),
        "_mean": F.avg(share), "_sd": F.stddev_pop(share)})
    return based.select(
        *metrics.columns, "rank", "n",
        F.when(F.col("n") < S.MIN_BASELINE, 0.0).otherwise(
            exact_z(volume, F.col("n"), F.col("_total"), F.col("_squares"))).alias("volume_z"),
        flat_or_z(share, F.col("_mean"), F.col("_sd"), F.col("n")).alias("negative_z"))


def scored_brands(facts: DataFrame, windows: DataFrame, history: int = S.HISTORY_WINDOWS) -> DataFrame:
    """Each brand in each window with the z of its mentions, missing windows counting as 0.

    Sums over the windows where the brand occurs are enough; no windows x brands grid.
    """
    rows = facts.select("window_start", "brand", "mentions").join(
        windows.select("window_start", "rank"), "window_start")
    based = look_back(rows, ["brand"], "rank", history, {
        "_total": F.sum("mentions"), "_squares": F.sum(F.col("mentions") * F.col("mentions"))})
    n = F.least(F.col("rank") - 1, F.lit(history))
    return based.select(
        "window_start", "brand", "mentions", "rank", n.alias("n"),
        exact_z(F.col("mentions"), n, F.coalesce("_total", F.lit(0)),
                F.coalesce("_squares", F.lit(0))).alias("brand_z"))


def enough_history(rank: Column) -> Column:
    """The detector stays silent until there are MIN_WINDOWS windows."""
    return rank >= S.MIN_WINDOWS


def _score(z: Column) -> Column:
    return F.bround(F.least(z / 5, F.lit(1.0)), 3)


def _severity(z: Column) -> Column:
    return F.when(z >= S.HIGH_Z, "High").otherwise("Medium")


def _whole(value: Column) -> Column:
    return F.bround(value).cast("bigint").cast("string")


def _alert(prefix: Column, title: Column, severity: Column, reason: Column, score: Column,
           metric: str, brand: Column | None = None) -> list[Column]:
    start = iso_utc(F.col("window_start"))
    return [F.concat(prefix, start).alias("id"), title.alias("title"), severity.alias("severity"),
            reason.alias("reason"), score.alias("score"), F.lit(metric).alias("metric"),
            (F.lit(None).cast("string") if brand is None else brand).alias("brand"),
            start.alias("window")]


def window_rules(windows: DataFrame) -> DataFrame:
    """Volume spikes and negative surges in one pass over the scored windows."""
    volume, z = F.col("volume"), F.col("volume_z")
    spike = F.struct(*_alert(
        F.lit("window-volume-"), F.lit(S.SPIKE_TITLE), _severity(z),
        F.concat(F.lit(S.SPIKE_REASON[0]), volume.cast("string"), F.lit(S.SPIKE_REASON[1]), plain(z, 1),
                 F.lit(S.SPIKE_REASON[2])), _score(z), "volume"))
    share, nz = F.col("negative_ratio"), F.col("negative_z")
    surge = F.struct(*_alert(
        F.lit("window-negative-"), F.lit(S.SURGE_TITLE), _severity(nz),
        F.concat(F.lit(S.SURGE_REASON[0]), _whole(share * 100), F.lit(S.SURGE_REASON[1]), plain(nz, 1),
                 F.lit(S.SURGE_REASON[2])), _score(nz), "negative_ratio"))
    raised = F.array(F.when((z >= S.ALERT_Z) & (volume >= S.MIN_SPIKE_VOLUME), spike),
                     F.when((nz >= S.ALERT_Z) & (share >= S.MIN_NEGATIVE_RATIO), surge))
    return windows.filter(enough_history(F.col("rank"))).select(F.inline(F.array_compact(raised)))


def volume_spikes(windows: DataFrame) -> DataFrame:
    return window_rules(windows).filter(F.col("metric") == "volume")


def negative_surges(windows: DataFrame) -> DataFrame:
    return window_rules(windows).filter(F.col("metric") == "negative_ratio")


def brand_spikes(brands: DataFrame) -> DataFrame:
    z, brand = F.col("brand_z"), F.col("brand")
    reason = F.concat(F.col("mentions").cast("string"), F.lit(S.BRAND_REASON[0]), brand,
                      F.lit(S.BRAND_REASON[1]), plain(z, 1), F.lit(S.BRAND_REASON[2]))
    return brands.filter(enough_history(F.col("rank")) & (z >= S.ALERT_Z)
                         & (F.col("mentions") >= S.MIN_SPIKE_VOLUME)) \
        .select(*_alert(F.concat(F.lit("brand-"), brand, F.lit("-")),
                        F.concat(F.lit(S.BRAND_TITLE), brand), F.lit("Medium"),
                        reason, _score(z), "brand_volume", brand))


def all_window_alerts(facts: DataFrame, seconds: int = S.WINDOW_SECONDS) -> DataFrame:
    """The three z-score rules on every window, a back-test of the whole history."""
    windows = scored_windows(window_metrics(facts), seconds)
    return window_rules(windows).unionByName(brand_spikes(scored_brands(facts, windows)))


def latest_window_alerts(facts: DataFrame, seconds: int = S.WINDOW_SECONDS,
                         history: int = S.HISTORY_WINDOWS) -> DataFrame:
    """The three z-score rules on the latest window.

    Only the windows that can matter are scored: the newest `history` + 1 ones, found
    by a top-k, and the facts that fall in them. `facts` is read several times: settle it.
    """
    newest = facts.select("window_start").distinct().orderBy(F.desc("window_start")).limit(history + 1)
    near = facts.join(F.broadcast(newest), "window_start", "left_semi")
    latest = near.select(iso_utc(F.max("window_start"))).scalar()
    return all_window_alerts(near, seconds).filter(F.col("window") == latest)
