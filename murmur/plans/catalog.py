"""Every operator as a query over the driver tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from murmur import schemas
from murmur import settings as S
from murmur.functions import display, sentiment, text
from murmur.functions.fixed import plain
from murmur.operators import aggregates as A
from murmur.operators import alerts as alert_ops
from murmur.operators import cube, filters, guards, isolation, paging, replay, search, windows
from murmur.operators.detector import score_all_windows, score_windows
from murmur.operators.scoring import score_batch, token_rows
from murmur.plans import dashboard as D
from murmur.plans.mentions import (documents, events, few_with_tweet, lexicon, mentions, scored_documents,
                                   table, with_document, with_tweet)
from murmur.session import scratch_folder, settle, shuffles_dropped, spread
from murmur.sources import files, history, normalise
from murmur.sources.states import merge_batch, read_state
from murmur.streaming import ingest, jobs, limits, sinks

# The driver's events are sparse: an hour holds about as many as a live minute does.
HOUR = 3600
NEEDLE = "#"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def stamp(column: str, pattern: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(column, pattern).alias(column)


def text_step(name: str, *steps):
    """Register one cleaning step applied to every document."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        value = F.col("tweet")
        for step in steps:
            value = step(value)
        return spread(documents(spark, sf_dir)).select("doc_id", value.alias("result"))
    QUERIES[name] = run


def joined(tokens):
    return F.array_join(tokens, " ")


text_step("c1_text_or_empty", lambda t: F.nullif(t, F.lit("")), text.text_or_empty)
text_step("c2_lowercase", text.lowercase)
text_step("c3_remove_urls", text.lowercase, text.remove_urls)
text_step("c4_remove_mentions", text.lowercase, text.remove_mentions)
text_step("c5_remove_hashtag_symbols", text.lowercase, text.remove_hashtag_symbols)
text_step("c6_remove_emojis", text.lowercase, text.remove_emojis)
text_step("c7_remove_punctuation", text.lowercase, text.remove_punctuation)
text_step("c8_collapse_whitespace", text.lowercase, text.collapse_whitespace)
text_step("c9_tokenize", text.all_tokens, joined)
text_step("c10_remove_stopwords", text.clean_tokens, joined)
text_step("c11_clean_tweet", text.clean_tweet)


# --- sentiment scoring -------------------------------------------------------

@query
def n1_lexicon_score(spark, sf):
    return scored_documents(spark, sf).select("doc_id", "polarity", "subjectivity")


@query
def n2_label_from_polarity(spark, sf):
    return scored_documents(spark, sf).select("doc_id", sentiment.label(F.col("polarity")).alias("label"))


@query
def n3_confidence(spark, sf):
    return scored_documents(spark, sf).select(
        "doc_id", sentiment.confidence(F.col("polarity"), F.col("subjectivity")).alias("confidence"))


@query
def n4_score_empty(spark, sf):
    """Documents without a word of the lexicon."""
    rows = scored_documents(spark, sf)
    return rows.filter((F.col("subjectivity") == 0) & (F.col("confidence") == 0))


@query
def n5_score_struct(spark, sf):
    """The batch scorer, as streams use it, on the second source of texts."""
    turns = table(spark, sf, "conversations").withColumnRenamed("text", "tweet")
    return score_batch(spread(turns), lexicon(spark, sf))


@query
def n6_sentiment_score(spark, sf):
    return A.sentiment_score(mentions(spark, sf))


@query
def n7_polarity_bucket(spark, sf):
    p = F.col("polarity")
    return scored_documents(spark, sf).select(
        "doc_id", sentiment.polarity_bucket(p).alias("bucket"), sentiment.bucket_order(p).alias("position"))


@query
def n8_colours(spark, sf):
    return scored_documents(spark, sf).select(
        "doc_id", sentiment.label_colour(F.col("sentiment")).alias("label_colour"),
        sentiment.polarity_colour(F.col("polarity")).alias("polarity_colour"))


# --- filters and projections -------------------------------------------------

@query
def f1_filter_brand(spark, sf):
    return events(spark, sf).filter(filters.is_brand("CLICK")).select("mention_id", "brand")


@query
def f2_filter_sentiment(spark, sf):
    return mentions(spark, sf).filter(filters.is_sentiment("negative")).select("mention_id", "sentiment")


def searched(spark, sf, needle):
    """Scored mentions with text_hit, found once per document."""
    return with_document(mentions(spark, sf), sf, text_hit=filters.holds(F.col("tweet"), needle))


@query
def f3_filter_search(spark, sf):
    rows = with_document(events(spark, sf), sf, text_hit=filters.holds(F.col("tweet"), NEEDLE))
    return rows.filter(F.col("text_hit") | filters.holds(F.col("brand"), NEEDLE)).select("mention_id", "brand")


@query
def f3_index_search(spark, sf):
    """The same by an index of trigrams, for a needle that few documents hold."""
    path = scratch_folder(spark, "index")
    search.build_index(documents(spark, sf), path, "doc_id", "tweet")
    hits = search.search(spark, path, "Apache License", "tweet").select("doc_id")
    return events(spark, sf).join(hits, "doc_id").select("mention_id", "brand")


@query
def f4_filter_days(spark, sf):
    return filters.last_days(events(spark, sf), 7).select("mention_id", stamp("timestamp", MICROS))


@query
def f5_filtered(spark, sf):
    rows = searched(spark, sf, NEEDLE).filter(
        filters.is_brand("all") & filters.is_sentiment("Negative")
        & (F.col("text_hit") | filters.holds(F.col("brand"), NEEDLE)))
    return filters.last_days(rows, 7).select("mention_id", "brand", "sentiment", "polarity")


@query
def f6_drop_bad_timestamp(spark, sf):
    """Timestamps read back from text; the JSON of props is no timestamp and goes."""
    stamps = table(spark, sf, "events").select("event_id", F.explode(F.array(
        F.col("ts").cast("string"), F.col("props"))).alias("raw"))
    parsed = stamps.withColumn("timestamp", display.parse_timestamp(F.col("raw")))
    return filters.drop_bad_timestamp(parsed).select("event_id", stamp("timestamp", MICROS))


@query
def f7_slicer_values(spark, sf):
    return filters.slicer_values(mentions(spark, sf))


@query
def f7_slicer(spark, sf):
    rows = with_document(mentions(spark, sf), sf, hit=filters.holds(text.clean_tweet(F.col("tweet")), "the"))
    chosen = filters.slicer(rows, ["Positive", "Negative"], ["click", "view"],
                            "2024-01-05", "2024-01-20")
    return chosen.filter("hit").select("mention_id", "brand", "sentiment")


@query
def f8_brands_list(spark, sf):
    return filters.brands_list(events(spark, sf))


@query
def f9_spreadsheet_safe(spark, sf):
    """Cells of every kind of start, from the events' own text."""
    starts = F.array(*[F.lit(s) for s in ("=", "  +", "\t-", "\r\n@", "", "a=")])
    cell = F.concat(F.get(starts, (F.col("event_id") % 6).cast("int")), F.col("event_type"))
    return table(spark, sf, "events").select("event_id", display.spreadsheet_safe(cell).alias("cell"))


@query
def f10_tweet_hash(spark, sf):
    rows = with_tweet(events(spark, sf), sf)
    return rows.select("mention_id", display.tweet_hash(
        F.date_format("timestamp", MICROS), F.col("tweet")).alias("tweet_hash"))


@query
def f11_report_snippet(spark, sf):
    return table(spark, sf, "pages").select("page_id", display.report_snippet(F.col("html")).alias("snippet"))


@query
def f12_relative_age(spark, sf):
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp")
    return events(spark, sf).select("mention_id", display.relative_age(F.col("timestamp"), as_of).alias("age"))


# --- aggregations ------------------------------------------------------------

@query
def a1_kpi_counts(spark, sf):
    return A.kpi_counts(mentions(spark, sf))


@query
def a2_kpi_pct(spark, sf):
    return A.kpi_shares(A.kpi_counts(mentions(spark, sf)))


@query
def a3_neutral_remainder(spark, sf):
    rows = A.neutral_remainder(A.kpi_shares(A.kpi_counts(mentions(spark, sf))))
    return rows.select("positive_pct", "negative_pct", "neutral_rest_pct")


@query
def a4_avg_scores(spark, sf):
    return A.avg_scores(mentions(spark, sf))


@query
def a5_tweets_per_min(spark, sf):
    return A.tweets_per_min(events(spark, sf))


@query
def a6_by_brand(spark, sf):
    return A.by_brand(mentions(spark, sf))


@query
def a7_a8_brand_measures(spark, sf):
    return A.brand_measures(mentions(spark, sf))


@query
def a9_brand_sentiment_mix(spark, sf):
    return A.brand_sentiment_mix(mentions(spark, sf))


@query
def a10_sentiment_distribution(spark, sf):
    return A.sentiment_distribution(mentions(spark, sf))


@query
def a11_sentiment_summary(spark, sf):
    return A.sentiment_summary(mentions(spark, sf))


@query
def a12_bucket_histogram(spark, sf):
    return A.bucket_histogram(mentions(spark, sf))


@query
def a13_scatter_points(spark, sf):
    return A.scatter_points(mentions(spark, sf))


@query
def a14_word_frequency(spark, sf):
    """Words over all mentions: a document counts as often as it is mentioned.

    The number of mentions joins the documents, not their many more words.
    """
    return A.count_words(mentioned_words(spark, sf))


def mentioned_words(spark, sf):
    """(word, n): each cleaned token of a document with the document's mentions."""
    times = events(spark, sf).groupBy("doc_id").agg(F.count("*").alias("n"))
    docs = spread(documents(spark, sf)).join(times, "doc_id")
    return docs.select("n", F.explode(text.clean_tokens(F.col("tweet"))).alias("word"))


@query
def a15_timeline_minute_of_day(spark, sf):
    return A.timeline_minute_of_day(mentions(spark, sf))


@query
def a16_resample_minute(spark, sf):
    rows = A.resample_minute(mentions(spark, sf))
    return rows.select(stamp("minute"), "volume", "avg_polarity")


@query
def a17_trend_by_sentiment(spark, sf):
    return A.trend_by_sentiment(mentions(spark, sf)).select(stamp("window_start"), "sentiment", "n")


@query
def a17_score_trend(spark, sf):
    rows = A.score_trend(mentions(spark, sf))
    return rows.select(stamp("timestamp", MICROS), "avg_polarity", "avg_subjectivity")


def facts(spark, sf, seconds=HOUR):
    """Window facts, settled: the detector reads them several times, the mentions once."""
    return settle(windows.window_facts(mentions(spark, sf), seconds))


@query
def a18_tumbling_metrics(spark, sf):
    rows = windows.tumbling_metrics(facts(spark, sf))
    entries = F.array_sort(F.map_entries("brands"))
    shown = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return rows.select(stamp("window_start"), "volume", "mean_polarity",
                       F.round("negative_ratio", 6).alias("negative_ratio"), shown.alias("brands"))


@query
def a18_tumbling_minute(spark, sf):
    """The default window of one minute."""
    rows = windows.window_metrics(facts(spark, sf, S.WINDOW_SECONDS))
    return rows.select(stamp("window_start"), "volume", "mean_polarity",
                       F.round("negative_ratio", 6).alias("negative_ratio"))


@query
def a19_gauges(spark, sf):
    return alert_ops.gauges(events(spark, sf), alert_state(spark, sf))


@query
def a20_report_summary(spark, sf):
    return A.report_summary(mentions(spark, sf))


@query
def a21_latest_window_count(spark, sf):
    """The span is an hour here: the newest 30 seconds hold one event."""
    return A.latest_window_count(events(spark, sf), HOUR)


@query
def a22_latest_avg_polarity(spark, sf):
    return A.latest_avg_polarity(mentions(spark, sf), 60)


@query
def a22_rolling_avg_polarity(spark, sf):
    rows = A.rolling_avg_polarity(mentions(spark, sf))
    return rows.select(stamp("second"), "n", "rolling_avg_polarity")


# --- windows and anomalies ---------------------------------------------------

def windows_scored(spark, sf):
    return windows.scored_windows(windows.window_metrics(facts(spark, sf)), HOUR)


@query
def w1_trailing_baseline(spark, sf):
    return windows_scored(spark, sf).select(stamp("window_start"), "rank", "n")


@query
def w2_zscore(spark, sf):
    return windows_scored(spark, sf).select(
        stamp("window_start"), F.round("volume_z", 6).alias("volume_z"),
        F.round("negative_z", 6).alias("negative_z"))


@query
def w2_zscore_gap_filled(spark, sf):
    """Five-minute windows where empty ones count as zero."""
    metrics = windows.window_metrics(facts(spark, sf, 300))
    rows = windows.scored_windows(windows.gap_fill(metrics, 300), 300)
    return rows.select(stamp("window_start"), "volume", F.round("volume_z", 6).alias("volume_z"))


@query
def w3_min_history(spark, sf):
    rows = windows_scored(spark, sf)
    return rows.select(stamp("window_start"), windows.enough_history(F.col("rank")).alias("watched"))


@query
def w4_volume_spike(spark, sf):
    return windows.volume_spikes(windows_scored(spark, sf))


@query
def w5_negative_surge(spark, sf):
    return windows.negative_surges(windows_scored(spark, sf))


@query
def w6_brand_zscore(spark, sf):
    base = facts(spark, sf)
    ranked = windows.scored_windows(windows.window_metrics(base), HOUR)
    rows = windows.scored_brands(base, ranked)
    return rows.select(stamp("window_start"), "brand", "mentions", "n", F.round("brand_z", 6).alias("brand_z"))


@query
def w6_brand_volume(spark, sf):
    base = facts(spark, sf)
    ranked = windows.scored_windows(windows.window_metrics(base), HOUR)
    return windows.brand_spikes(windows.scored_brands(base, ranked))


@query
def w7_isolation_forest(spark, sf):
    metrics = windows.window_metrics(facts(spark, sf))
    scored = isolation.latest_isolation(metrics, HOUR)
    return scored.select(stamp("window_start"), *isolation.FEATURES, F.round("isolation_score", 9).alias("isolation_score"))


@query
def w7_isolation_all(spark, sf):
    """Every window by the forest of those before it."""
    scored = isolation.isolation_scores(windows.window_metrics(facts(spark, sf)), HOUR)
    return scored.select(stamp("window_start"), "rank", F.round("isolation_score", 9).alias("isolation_score"))


@query
def w7_isolation_flag(spark, sf):
    """What is sure of the forest: an hour with 60 negative rows put in is flagged, and its features are exact."""
    scored = isolation.latest_isolation(windows.window_metrics(spiked_facts(spark, sf)), HOUR)
    score = F.col("isolation_score")
    return scored.select(stamp("window_start"), *isolation.FEATURES, score.between(-0.5, 0.5).alias("in_range"),
                         (score >= S.FOREST_ALERT).alias("flagged"))


@query
def w8_score_windows(spark, sf):
    """The latest window, the one with the spike, under all rules, the forest included."""
    return score_windows(spiked_facts(spark, sf), HOUR)


@query
def w8_back_test(spark, sf):
    """Every window under all rules, the forest included."""
    return score_all_windows(facts(spark, sf), HOUR)


@query
def w9_brand_bar_norm(spark, sf):
    rows = A.brand_bars(A.by_brand(mentions(spark, sf)))
    return rows.withColumn("width", F.round("width", 6))


# --- sort, limit, paging -----------------------------------------------------

@query
def l1_page(spark, sf):
    rows = paging.page(filters.filtered(mentions(spark, sf), "click"), 3)
    return few_with_tweet(rows, sf).select("mention_id", stamp("timestamp", MICROS), "tweet", "sentiment")


@query
def l1_page_after(spark, sf):
    rows = paging.page_after(events(spark, sf), "2024-01-15 00:00:00", 0)
    return rows.select("mention_id", stamp("timestamp", MICROS))


@query
def l1_far_page(spark, sf):
    """A page from the middle of all rows, found by counts of minutes."""
    rows = settle(events(spark, sf))
    counts = rows.groupBy(F.date_trunc("minute", "timestamp").alias("minute")).agg(F.count("*").alias("n"))
    middle = rows.count() // 2 // S.PAGE_SIZE
    return paging.far_page(rows, counts, middle + 1).select("mention_id", stamp("timestamp", MICROS))


@query
def l1_page_info(spark, sf):
    rows = events(spark, sf)
    return paging.page_info(filters.filtered(rows, "click"), rows, 3)


@query
def l2_latest_feed(spark, sf):
    rows = paging.latest(events(spark, sf), 100)
    return few_with_tweet(rows, sf).select("mention_id", stamp("timestamp", MICROS), "brand", "tweet")


@query
def l3_recent_30(spark, sf):
    return paging.latest(mentions(spark, sf), S.REPORT_ROWS).select("mention_id", "sentiment", "polarity")


@query
def l4_top_brands(spark, sf):
    rows = events(spark, sf).groupBy("brand").agg(F.count("*").alias("total"))
    return rows.orderBy(F.desc("total"), "brand").limit(S.TOP_BRANDS)


def audit_log(spark, sf):
    """The events as an audit log."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("event"), F.col("props").alias("detail"),
        F.col("ts").cast("timestamp").alias("created_at"))


@query
def l5_audit_recent(spark, sf):
    return paging.audit_recent(audit_log(spark, sf), 500).withColumn("created_at", stamp("created_at", MICROS))


@query
def l6_alerts_recent(spark, sf):
    rows = paging.alerts_recent(alert_state(spark, sf))
    return rows.select("alert_id", "title", "status", stamp("updated_at", MICROS))


# --- alerts: rules, joins, unions, state -------------------------------------

def alert_log(spark, sf):
    """The events as saves of alerts, one alert per user."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("alert_id"),
        F.col("event_type").alias("title"), F.col("props").alias("detail"),
        F.when(F.col("value") >= 20, "High").otherwise("Medium").alias("severity"),
        F.when(F.col("value") >= 40, "Acknowledged").otherwise("Open").alias("status"),
        F.col("ts").cast("timestamp").alias("at"))


def alert_actions(spark, sf):
    """The events as actions on those alerts."""
    action = (F.when(F.col("title") == "click", "acknowledge").when(F.col("title") == "purchase", "resolve")
              .otherwise(F.col("title")))
    return alert_log(spark, sf).select("alert_id", action.alias("action"), "at")


def alert_state(spark, sf):
    return alert_ops.fold_alert_log(alert_log(spark, sf))


def shown_state(state):
    return state.select("alert_id", "title", "detail", "severity", "status",
                        stamp("created_at", MICROS), stamp("updated_at", MICROS))


@query
def r1_negative_share_alert(spark, sf):
    return alert_ops.negative_share_alert(mentions(spark, sf))


@query
def r2_alert_fold(spark, sf):
    return shown_state(alert_state(spark, sf))


@query
def r2_alert_upsert(spark, sf):
    log = alert_log(spark, sf)
    old = alert_ops.fold_alert_log(log.filter("at < '2024-01-16'"))
    return shown_state(alert_ops.upsert_alerts(old, log.filter("at >= '2024-01-16'")))


def stored_alerts(spark, sf, name):
    """The alert log merged batch by batch into a stored table, every batch twice; its path."""
    path = scratch_folder(spark, name)
    log = settle(alert_log(spark, sf))
    for number, (since, until) in enumerate((("2000-01-01", "2024-01-08"), ("2024-01-08", "2024-01-16"), ("2024-01-16", "2024-01-24"), ("2024-01-24", "2100-01-01"))):
        batch = log.filter((F.col("at") >= since) & (F.col("at") < until))
        for _ in range(2):
            alert_ops.store_alerts(batch, number, path)
    return path


@query
def r2_stored_alerts(spark, sf):
    """Alerts kept in a table; a batch that comes again changes nothing."""
    return shown_state(alert_ops.stored_alerts(spark, stored_alerts(spark, sf, "r2")))


@query
def r3_stored_transitions(spark, sf):
    path = stored_alerts(spark, sf, "r3")
    alert_ops.store_transitions(alert_actions(spark, sf), 4, path)
    return shown_state(alert_ops.stored_alerts(spark, path))


@query
def r3_alert_transition(spark, sf):
    return shown_state(alert_ops.apply_transitions(alert_state(spark, sf), alert_actions(spark, sf)))


@query
def r3_loose_statuses(spark, sf):
    """Actions on alerts that the first day's log does not know."""
    known = alert_ops.fold_alert_log(alert_log(spark, sf).filter("at < '2024-01-02'"))
    return alert_ops.loose_statuses(known, alert_actions(spark, sf)).select("alert_id", "status", stamp("at", MICROS))


def current_and_stored(spark, sf):
    """Alerts of the hourly back-test, stored ones of which half the ids differ, session ones."""
    base = windows.all_window_alerts(facts(spark, sf), HOUR)
    current = settle(alert_ops.as_alerts(base).drop("time"))
    stored = current.withColumn("id", F.when(F.col("severity") == "High", F.col("id"))
                                .otherwise(F.concat(F.lit("old-"), F.col("id"))))
    session = current.withColumn("id", F.when(F.col("title") == "Tweet volume spike", F.col("id"))
                                 .otherwise(F.concat(F.lit("demo-"), F.col("id"))))
    return current, stored, session


@query
def j1_u3_alert_status_overlay(spark, sf):
    current, stored, session = current_and_stored(spark, sf)
    return alert_ops.status_overlay(
        current,
        session.select(F.col("id").alias("alert_id"), F.lit("Resolved").alias("status")),
        stored.select(F.col("id").alias("alert_id"), F.lit("Acknowledged").alias("status")),
        current.filter("title = 'Negative sentiment surge'").select(
            F.col("id").alias("alert_id"), F.lit("Resolved").alias("status")))


@query
def j2_alert_anti(spark, sf):
    current, stored, _ = current_and_stored(spark, sf)
    return alert_ops.not_listed(stored, current)


@query
def u1_alerts_union(spark, sf):
    return alert_ops.all_alerts(*current_and_stored(spark, sf))


@query
def alerts_list(spark, sf):
    """The alert list with a spike in the latest window: share rule, detector, forest, saved and session alerts."""
    rows, spike = spiked(spark, sf)
    at = F.lit("2024-01-31 00:30:00").cast("timestamp")
    both = rows.unionByName(spike.drop("value"))
    detected = score_windows(settle(windows.window_facts(both, HOUR)), HOUR)
    current = settle(alert_ops.current_alerts(both, detected))
    saved = alert_ops.save_current(alert_state(spark, sf), current, at)
    actions = alert_actions(spark, sf).unionByName(current.filter("title = 'Tweet volume spike'").select(
        F.col("id").alias("alert_id"), F.lit("acknowledge").alias("action"), at.alias("at")))
    return alert_ops.alert_list(current, saved, actions, replay.spike_alerts(spike))


@query
def j3_timeline_anomaly_marks(spark, sf):
    rows = settle(mentions(spark, sf))
    alerts = windows.all_window_alerts(settle(windows.window_facts(rows, HOUR)), HOUR)
    return alert_ops.timeline_marks(A.timeline_minute_of_day(rows), alerts)


@query
def j4_zero_fill(spark, sf):
    """Zero-filled counts per brand over the last 30 windows, without the grid of all pairs."""
    base = facts(spark, sf)
    newest = base.select("window_start").distinct().orderBy(F.desc("window_start")).limit(S.HISTORY_WINDOWS)
    near = base.join(F.broadcast(newest), "window_start", "left_semi")
    n = near.select(F.count_distinct("window_start")).scalar()
    return near.groupBy("brand").agg(F.sum("mentions").alias("mentions"), F.count("*").alias("present")) \
        .withColumn("zero_windows", n - F.col("present"))


@query
def t4_j5_meta_lookup(spark, sf):
    """Brand and user of each turn by its text, from the documents; most have none."""
    source = table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("tweet_text"), F.col("lang").alias("brand"),
        F.col("source").alias("username"))
    messages = table(spark, sf, "documents").select(F.col("doc_id").alias("tweet_id"),
                                                    F.col("text").alias("tweet_text")).unionByName(
        table(spark, sf, "conversations").select((-F.col("conv_id") * 1000 - F.col("turn")).alias("tweet_id"),
                                                 F.col("text").alias("tweet_text")))
    return replay.with_meta(messages, source, "doc_id").select("tweet_id", "brand", "username")


@query
def j6_lexicon_join(spark, sf):
    """Lexicon hits per word over all documents."""
    tokens = token_rows(spread(documents(spark, sf)), "doc_id", "tweet").groupBy("word").agg(F.count("*").alias("n"))
    return tokens.join(lexicon(spark, sf), "word").select("word", "n", "polarity")


@query
def j7_stopword_anti(spark, sf):
    """How many tokens the stop words leave, by language."""
    docs = spread(table(spark, sf, "documents").select("lang", "text"))
    tokens = docs.select("lang", text.all_tokens(F.col("text")).alias("t"))
    return tokens.groupBy("lang").agg(F.sum(F.size("t")).alias("tokens"),
                                      F.sum(F.size(text.remove_stopwords(F.col("t")))).alias("kept"))


@query
def u2_concat_parts(spark, sf):
    """One scan over several files: the texts of documents and benchmark."""
    both = spark.read.schema("text STRING").parquet(f"{sf}/documents.parquet", f"{sf}/benchmark.parquet")
    return both.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query
def u4_distinct_brands(spark, sf):
    return events(spark, sf).select("brand").distinct()


@query
def r4_dedup_insert(spark, sf):
    """Documents by text, first one wins, texts of the benchmark already known."""
    docs = table(spark, sf, "documents").select(F.sha2("text", 256).alias("tweet_hash"), "doc_id", "lang", "source")
    known = table(spark, sf, "benchmark").select(F.sha2("text", 256).alias("tweet_hash"))
    return history.unseen(docs, known, "doc_id")


@query
def r5_fixed_window(spark, sf):
    """Users with over 3 events on one day."""
    return guards.fixed_window_breaches(events(spark, sf), "username", 3, 86_400)


@query
def r5_sliding_all_attempts(spark, sf):
    return guards.busy_seconds(events(spark, sf), "username", 3, 86_400)


@query
def r5_sliding_exact(spark, sf):
    return guards.sliding_window_refusals(events(spark, sf), "username", 3, 86_400)


@query
def r6_login_burst(spark, sf):
    """Failed attempts are the error events; over 2 within 5 days."""
    return guards.sliding_window_refusals(events(spark, sf).filter("brand = 'error'"), "username", 2, 432_000)


@query
def r7_lockout_intervals(spark, sf):
    """Every event but a signup is a failed attempt; a lock lasts a day."""
    return guards.lockouts(events(spark, sf), "username", "mention_id", F.col("brand") != "signup", 5, 86_400)


# --- sources -----------------------------------------------------------------

def csv_copy(spark, sf, rows, name, header):
    path = scratch_folder(spark, name)
    rows.write.options(**sinks.PACKED).csv(path, header=header, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
                   ignoreTrailingWhiteSpace=False)
    return path


def raw_rows(spark, sf):
    """The documents in the layout of the raw dataset."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("tweet_id"), F.col("lang").alias("entity"),
        F.col("source").alias("sentiment_label"), F.col("text").alias("tweet_text"))


@query
def s2_csv_detect_headerless(spark, sf):
    path = csv_copy(spark, sf, raw_rows(spark, sf), "raw", False)
    return files.read_detected_csv(spark, path)


@query
def s2_csv_detect_header(spark, sf):
    path = csv_copy(spark, sf, raw_rows(spark, sf), "headed", True)
    return files.read_detected_csv(spark, path)


@query
def s2_csv_to_messages(spark, sf):
    """From a raw CSV to messages: columns detected, brand and user looked up by text, message built."""
    rows = files.dataset_rows(files.read_detected_csv(spark, csv_copy(spark, sf, raw_rows(spark, sf), "dataset", False)), ("tweet_id",))
    source = rows.withColumn("tweet_id", F.col("tweet_id").cast("bigint"))
    messages = replay.with_meta(source.select("tweet_id", "tweet_text"), source, "tweet_id")
    built = ingest.build_messages(messages, F.lit("2024-01-01").cast("timestamp"))
    return built.select("key", F.from_json("value", schemas.MESSAGE).alias("m")).select(
        "key", F.md5("m.tweet_text").alias("digest"), "m.brand", "m.username", "m.produced_at")


@query
def s3_csv_folder(spark, sf):
    rows = with_tweet(mentions(spark, sf), sf).drop("doc_id")
    path = csv_copy(spark, sf, rows.withColumn("timestamp", F.date_format("timestamp", MICROS)), "parts", True)
    back = files.read_result_folder(spark, path)
    return back.select("mention_id", stamp("timestamp", MICROS), F.md5("tweet").alias("digest"), "sentiment", "polarity",
                       "confidence")


def scored_rows(spark, sf):
    return mentions(spark, sf).drop("doc_id")


@query
def s4_latest_snapshot(spark, sf):
    """Three snapshots of several files written one after the other; only the last one's rows are seen."""
    path = scratch_folder(spark, "snapshots")
    for part in range(3):
        rows = table(spark, sf, "documents").filter(F.col("doc_id") % 3 == part)
        rows.select("doc_id", "lang", "source").repartition(4).write.parquet(f"{path}/{part}")
    return files.newest_snapshot_rows(spark.read.option("recursiveFileLookup", "true").parquet(path))


@query
def s5_normalise(spark, sf):
    """Conversation turns under alias names, some empty; numbers that are none."""
    raw = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.lit("").alias("tweet"), F.col("text").alias("tweet_text"),
        F.when(F.col("role") == "user", "").otherwise(F.col("role")).alias("brand"),
        F.col("role").alias("entity"), F.lit("").alias("user"), F.col("role").alias("sentiment_label"),
        F.col("role").alias("polarity"), F.col("turn").cast("string").alias("subjectivity"),
        # A date, a time alone, and no stamp at all: only the first is an instant.
        F.when(F.col("turn") % 3 == 0, F.lit("2024-01-05T10:20:30")).when(F.col("turn") % 3 == 1, F.lit("10:20:30"))
        .otherwise("").alias("produced_at"))
    return normalise.normalise(raw, keep=("conv_id", "turn")).withColumn("timestamp", stamp("timestamp"))


@query
def s6_label_impute(spark, sf):
    """Quality labels as sentiment labels; 'unsure' is unknown and becomes Neutral."""
    labels = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    raw = labels.select(
        "doc_id", F.col("text").alias("tweet_text"), F.lit("").alias("entity"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
        .otherwise("unsure").alias("sentiment_label"))
    rows = normalise.impute_from_label(raw, "doc_id", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return rows.select("doc_id", stamp("timestamp"), F.md5("tweet").alias("digest"), "brand", "username",
                       "sentiment", "polarity", "subjectivity", "confidence")


@query
def s7_history_latest(spark, sf):
    rows = paging.latest_ascending(events(spark, sf))
    return rows.select("mention_id", stamp("timestamp", MICROS), "brand")


@query
def s8_bi_csv(spark, sf):
    """The enriched table over the mentions, texts with quotes, commas and line breaks included."""
    rows = with_document(mentions(spark, sf), sf, tweet=F.concat(F.lit('a "quoted", '), F.col("tweet")),
                         clean_tweet=text.clean_tweet(F.col("tweet"))).select(
        F.date_format("timestamp", MICROS).alias("timestamp"), "tweet", "clean_tweet", "polarity", "subjectivity",
        "sentiment", "confidence", "brand", sentiment.polarity_bucket(F.col("polarity")).alias("polarity_bucket"))
    back = files.read_enriched(spark, csv_copy(spark, sf, rows, "enriched", True))
    return back.withColumns({"timestamp": F.date_format("timestamp", MICROS), "tweet": F.md5("tweet"),
                             "clean_tweet": F.md5(F.coalesce("clean_tweet", F.lit("")))})


@query
def s9_fallback(spark, sf):
    """No event is of the year 2000, so the history answers."""
    rows = events(spark, sf)
    chosen = files.rows_or_history(rows.filter("timestamp < '2000-01-01'"), rows)
    return chosen.groupBy("brand").agg(F.count("*").alias("n"))


# --- message transforms and replay -------------------------------------------

def messages(spark, sf):
    """Every mention as a topic row (key, value, timestamp); props stand in for malformed ones."""
    rows = with_tweet(events(spark, sf), sf).select(
        F.col("mention_id").alias("tweet_id"), F.col("tweet").alias("tweet_text"), "brand", "username", "timestamp")
    good = ingest.build_messages(rows, F.col("timestamp")).withColumn("timestamp", F.lit(0).cast("timestamp"))
    bad = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("key"), F.col("props").alias("value"),
        F.lit(0).cast("timestamp").alias("timestamp"))
    return good.unionByName(bad)


@query
def t1_parse_json_payload(spark, sf):
    parsed = ingest.parse_json_payload(messages(spark, sf))
    return parsed.select("tweet_id", F.length("tweet").alias("chars"), F.md5("tweet").alias("digest"),
                         "produced_at", "brand", "username")


@query
def t1_malformed(spark, sf):
    return ingest.malformed(messages(spark, sf)).groupBy("json_value").agg(F.count("*").alias("n"))


@query
def t2_build_message(spark, sf):
    rows = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("tweet_id"), F.col("text").alias("tweet_text"),
        F.lit(" ").alias("brand"), F.lit(None).cast("string").alias("username"))
    return ingest.build_messages(rows, F.lit("2024-01-01").cast("timestamp"))


@query
def t3_drop_blank_text(spark, sf):
    """Lines of the documents, blank ones dropped."""
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("tweet"))
    return filters.drop_blank_text(lines).groupBy("doc_id").agg(
        F.count("*").alias("lines"), F.sum(F.length("tweet")).alias("chars"))


@query
def t5_limit_rows(spark, sf):
    first = replay.limit_rows(documents(spark, sf), 50, "doc_id")
    return filters.drop_blank_text(first).select("doc_id", F.length("tweet").alias("chars"))


@query
def t6_replay_cyclic(spark, sf):
    """The events replay the documents in a cycle, at the clock's full pace."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "lang", "source")
    ticks = table(spark, sf, "events").select(F.col("event_id").alias("value"), F.col("ts").alias("timestamp"))
    rows = replay.replay(ticks, docs, docs.count())
    return rows.groupBy("lang", "source").agg(F.count("*").alias("n"), F.max("value").alias("last"))


@query
def t6_replay_stream(spark, sf):
    """The same as a stream at half the clock's pace, ended in the middle of the third repeat."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "lang", "source")
    schema = table(spark, sf, "events").schema
    ticks = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf).select(
        F.col("event_id").alias("value"), F.col("ts").alias("timestamp"))
    base = scratch_folder(spark, "t6")
    n = docs.count()
    rows = replay.replay(replay.paced(ticks, 4.0), docs, n, 5 * n // 2)
    done = (rows.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(**ONCE).start())
    done.awaitTermination()
    back = spark.read.schema("value BIGINT, lang STRING, source STRING").parquet(f"{base}/out")
    return back.groupBy("lang", "source").agg(F.count("*").alias("n"), F.max("value").alias("last"))


def spiked(spark, sf, at="2024-01-31 00:00:00"):
    rows = settle(mentions(spark, sf))
    return rows, replay.spike_rows(rows, 60, F.lit(at).cast("timestamp"))


def with_spike(spark, sf, *at):
    rows, spike = spiked(spark, sf, *at)
    return rows.unionByName(spike.drop("value"))


def spiked_facts(spark, sf):
    return settle(windows.window_facts(with_spike(spark, sf), HOUR))


@query
def t7_inject_spike(spark, sf):
    """Alerts of the window a spike of 60 rows was put in."""
    return windows.latest_window_alerts(spiked_facts(spark, sf), HOUR)


@query
def t7_spike_alerts(spark, sf):
    return replay.spike_alerts(spiked(spark, sf)[1])


@query
def t8_retain_latest_n(spark, sf):
    return replay.retain_latest(events(spark, sf), "mention_id").select("mention_id", "brand")


# --- sinks and streams -------------------------------------------------------

def message_stream(spark, sf):
    """The mentions as a stream of topic rows with the texts of their documents."""
    schema = table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    n_docs = table(spark, sf, "documents").count()
    rows = raw.withColumn("doc_id", F.col("event_id") % n_docs).join(documents(spark, sf), "doc_id")
    body = F.to_json(F.struct(
        F.col("event_id").cast("int").alias("tweet_id"), F.col("tweet").alias("tweet_text"),
        F.date_format("ts", MICROS).alias("produced_at"), F.col("event_type").alias("brand"),
        F.col("user_id").cast("string").alias("username")))
    return rows.select(body.alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))


def dated_stream(spark, sf):
    return jobs.dated_mentions(ingest.parse_json_payload(message_stream(spark, sf)))


ONCE = {"availableNow": True}
STORED = {"header": True, **files.DIALECT}


@query
def k1_sink_csv_append(spark, sf):
    base = scratch_folder(spark, "k1")
    sinks.append_csv(dated_stream(spark, sf), lexicon(spark, sf), f"{base}/csv", f"{base}/checkpoint", **ONCE).awaitTermination()
    back = spark.read.csv(f"{base}/csv", **STORED)
    return back.select("tweet_id", F.md5("tweet").alias("digest"), "brand", "sentiment", "polarity", "confidence")


@query
def k2_console(spark, sf):
    """The console mirror of the parsed messages: by brand, the lines it printed and the sum of their ids."""
    stream = ingest.parse_json_payload(message_stream(spark, sf)).select("tweet_id", "brand")
    shown: dict[str, list[int]] = {}

    def write(line: str) -> None:
        row = json.loads(line)
        own = shown.setdefault(row["brand"], [0, 0])
        own[0] += 1
        own[1] += row["tweet_id"]
    sinks.to_console(stream, write, **ONCE).awaitTermination()
    return spark.createDataFrame([(b, *v) for b, v in shown.items()], "brand STRING, shown BIGINT, ids BIGINT")


@query
def k3_sink_history(spark, sf):
    """Two loads of the same rows leave one copy of each."""
    path = scratch_folder(spark, "k3") + "/history"
    rows = with_tweet(settle(mentions(spark, sf)), sf)
    for _ in range(2):
        history.insert_unseen(rows, path, "mention_id")
    return history.read_history(spark, path).groupBy("brand").agg(
        F.count("*").alias("n"), F.sum(F.length("tweet")).alias("chars"))


def finished_sinks(spark, sf, name):
    base = scratch_folder(spark, name)
    sinks.all_sinks(dated_stream(spark, sf), lexicon(spark, sf), base, **ONCE).awaitTermination()
    return base


@query
def k4_sink_live_batch(spark, sf):
    """Every row of the batch, in envelopes of at most 200."""
    base = finished_sinks(spark, sf, "k4")
    envelope = spark.read.text(f"{base}/live", wholetext=False).select(F.from_json(
        "value", "batch_id BIGINT, part BIGINT, tweets ARRAY<STRUCT<tweet_id: INT, tweet: STRING, brand: STRING, "
                 "sentiment: STRING, polarity: DOUBLE>>").alias("e"))
    rows = envelope.select("e.batch_id", (F.size("e.tweets") <= S.MAX_OFFSETS_PER_TRIGGER).alias("bounded"), F.inline("e.tweets"))
    return rows.withColumn("tweet", F.md5("tweet"))


@query
def st4_one_query_all_sinks(spark, sf):
    """What each sink of one query holds, row by row, with equal rows counted."""
    base = finished_sinks(spark, sf, "st4")
    sources = {"mentions": spark.read.parquet(f"{base}/mentions"), "csv": spark.read.csv(f"{base}/csv", **STORED),
               "history": history.read_history(spark, f"{base}/history")}
    # Digests are shuffled as 16 bytes: nearly every row is a group of its own.
    parts = [df.select(F.lit(name).alias("sink"), F.unhex(F.md5("tweet")).alias("digest"), "brand", "username", "sentiment",
                       F.col("polarity").cast("double").alias("polarity")) for name, df in sources.items()]
    with shuffles_dropped(spark):  # the history meets its texts before the rows of all sinks are shuffled
        parts[2] = settle(parts[2])
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).withColumn("digest", F.lower(F.hex("digest")))


def run_in_chunks(spark, chunks, start):
    """Run a stream once for each frame, from its checkpoint: a frame is all files it is written to, and a micro-batch.

    `start` gets the stream of all files and returns the started query.
    """
    path = scratch_folder(spark, "chunks")
    for chunk in chunks:
        chunk.write.mode("append").parquet(path)
        start(spark.readStream.schema(chunk.schema).parquet(path)).awaitTermination()


def mention_chunks(spark, sf, rows=None, frames=6):
    """Scored mentions in frames of some days each."""
    rows = settle(scored_rows(spark, sf) if rows is None else rows)
    day = F.datediff(F.to_date("timestamp"), F.to_date(F.lit("2024-01-01")))
    part = F.least(F.greatest(F.floor(day * frames / 30), F.lit(0)), F.lit(frames - 1))
    return [rows.filter(part == n) for n in range(frames)]


@query
def st1_stream_tumbling(spark, sf):
    """Windows of the stream over several batches; the batch job must give the same."""
    base = scratch_folder(spark, "st1")

    def start(stream):
        return (jobs.window_fact_stream(stream, HOUR).writeStream.outputMode("update").trigger(**ONCE)
                .option("checkpointLocation", f"{base}/checkpoint").foreachBatch(lambda rows, batch: sinks.write_batch(
                    rows.withColumn("day", F.to_date("window_start")), f"{base}/facts", batch)).start())
    run_in_chunks(spark, mention_chunks(spark, sf), start)
    rows = windows.window_metrics(jobs.current_facts(spark.read.parquet(f"{base}/facts")))
    return rows.select(stamp("window_start"), "volume", "mean_polarity",
                       F.round("negative_ratio", 6).alias("negative_ratio"))


@query
def st2_watermark_dedup(spark, sf):
    """Every mention twice within the watermark, and once more long after it.

    The copy within the watermark goes, the later one is new. The two chunks of one row
    between them move the watermark past the first chunk's state.
    """
    base = scratch_folder(spark, "st2")
    rows = settle(scored_rows(spark, sf).select("mention_id", "timestamp", "brand", F.lit("first").alias("chunk")))

    def later(frame, chunk, delay, salt=""):
        return frame.select("mention_id", (F.col("timestamp") + F.expr(f"INTERVAL {delay}")).alias("timestamp"), "brand",
                            F.lit(chunk).alias("chunk"),
                            F.sha2(F.concat(F.lit(salt), F.col("mention_id").cast("string")), 256).alias("tweet_hash"))
    one = rows.filter("mention_id = 0")
    chunks = [later(rows, "first", "0 SECONDS").unionByName(later(rows, "first", "5 MINUTES")),
              later(one, "gap", "100 DAYS", "a"), later(one, "gap", "200 DAYS", "b"), later(rows, "again", "300 DAYS")]
    run_in_chunks(spark, chunks, lambda stream: (
        jobs.first_seen(stream).writeStream.format("parquet").option("path", f"{base}/out")
        .trigger(**ONCE).option("checkpointLocation", f"{base}/checkpoint").outputMode("append").start()))
    return spark.read.parquet(f"{base}/out").groupBy("chunk", "brand").agg(F.count("*").alias("n"))


@query
def a22_stream_sliding(spark, sf):
    """Five minutes before every minute, as a stream over six batches; the newest version of a window counts."""
    base = scratch_folder(spark, "a22")
    run_in_chunks(spark, mention_chunks(spark, sf), lambda stream: (
        jobs.sliding_polarity_stream(stream).writeStream.outputMode("update").trigger(**ONCE).option("checkpointLocation", f"{base}/checkpoint")
        .foreachBatch(lambda rows, batch: sinks.write_batch(rows, f"{base}/out", batch)).start()))
    found = spark.read.parquet(f"{base}/out").groupBy("until").agg(F.max_by(F.struct("n", "rolling_avg_polarity"), "batch_id").alias("v"))
    return found.select(stamp("until"), "v.*")


@query
def st2_late_rows(spark, sf):
    """How many rows came after the watermark, by batch: all mentions, then those of the first days once more."""
    base = scratch_folder(spark, "late")
    rows = settle(scored_rows(spark, sf).select("mention_id", "timestamp", "brand"))
    hashed = rows.withColumn("tweet_hash", F.sha2(F.col("mention_id").cast("string"), 256))

    def start(stream):
        started.append(jobs.first_seen(stream).writeStream.format("parquet").option("path", f"{base}/out").trigger(**ONCE)
                       .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").start())
        return started[-1]
    started = []
    run_in_chunks(spark, [hashed, hashed.filter("timestamp < '2024-01-11'")], start)
    for done in started:
        jobs.late_rows(done, f"{base}/late")
    late = spark.read.schema(schemas.LATE_ROWS).parquet(f"{base}/late")
    return late.agg(F.sum("late").alias("late"), F.count_if(F.col("late") > 0).alias("batches"))


@query
def st3_stream_alerts(spark, sf):
    """Alerts the stream logs over several batches, with a spike some days before the end."""
    base = scratch_folder(spark, "st3")
    run_in_chunks(spark, mention_chunks(spark, sf, with_spike(spark, sf, "2024-01-20 12:00:00"), 3), lambda stream: jobs.alert_job(
        jobs.window_fact_stream(stream, HOUR), f"{base}/facts", f"{base}/alerts", f"{base}/checkpoint", HOUR, **ONCE))
    log = spark.read.schema(schemas.ALERT_LOG).parquet(f"{base}/alerts")
    return alert_ops.fold_alert_log(log).select("alert_id", "title", "detail", "severity", "status")


def event_chunks(spark, sf):
    """The log of attempts in six frames of some days each."""
    rows = settle(events(spark, sf).select("mention_id", "timestamp", "username", "brand"))
    day = F.datediff(F.to_date("timestamp"), F.to_date(F.lit("2024-01-01")))
    part = F.least(F.greatest(F.floor(day / 5), F.lit(0)), F.lit(5))
    return [rows.filter(part == n) for n in range(6)]


def kept_of_stream(spark, sf, name, rule):
    """What a keyed rule reports over six batches, each by a query restarted from its checkpoint."""
    base = scratch_folder(spark, name)
    with limits.keyed_state(spark):
        run_in_chunks(spark, event_chunks(spark, sf), lambda stream: (
            rule(stream).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(**ONCE).start()))
    return spark.read.parquet(f"{base}/out")


@query
def r5_stream(spark, sf):
    """The sliding limiter live; the batch job must give the same."""
    found = kept_of_stream(spark, sf, "r5", lambda log: limits.sliding_refusals(log, "username", 3, 86_400))
    return found.groupBy("key", "second").agg(F.sum("attempts").alias("attempts"), F.sum("refused").alias("refused"))


@query
def r6_stream(spark, sf):
    found = kept_of_stream(spark, sf, "r6", lambda log: limits.sliding_refusals(log.filter("brand = 'error'"), "username", 2, 432_000))
    return found.groupBy("key", "second").agg(F.sum("attempts").alias("attempts"), F.sum("refused").alias("refused"))


@query
def r7_stream(spark, sf):
    """Lock-outs live; the batch job must give the same."""
    return kept_of_stream(spark, sf, "r7", lambda log: limits.locks(log, "username", "mention_id", F.col("brand") != "signup", 5, 86_400))


@query
def k5_export_csv(spark, sf):
    path = scratch_folder(spark, "k5")
    rows = with_tweet(mentions(spark, sf), sf)
    D.export_csv(rows, path, brand="click", sentiment="Negative", days=30)
    back = spark.read.options(**files.DIALECT, header="true").csv(path)
    return back.withColumn("timestamp", F.date_format(F.col("timestamp").cast("timestamp"), MICROS))


@query
def k5_export_neutral(spark, sf):
    """The rows that carry small numbers; numbers stand in plain decimals."""
    path = scratch_folder(spark, "k5")
    D.export_csv(with_tweet(mentions(spark, sf), sf), path, sentiment="Neutral", days=30)
    back = spark.read.options(**files.DIALECT, header="true").csv(path)
    return back.select("brand", "username", F.md5("tweet").alias("digest"), "polarity", "subjectivity", "confidence",
                       F.date_format(F.col("timestamp").cast("timestamp"), MICROS).alias("timestamp"))


@query
def k6_chart_datasets(spark, sf):
    folder = scratch_folder(spark, "k6")
    D.write_charts(D.chart_datasets(settle(mentions(spark, sf)), mentioned_words(spark, sf)), folder)
    names = ("sentiment_distribution", "word_frequency", "time_series")
    shown = [spark.read.parquet(f"{folder}/{n}") for n in names]
    return (shown[0].select(F.lit(names[0]).alias("chart"), F.col("sentiment").alias("item"), "n")
            .unionByName(shown[1].select(F.lit(names[1]).alias("chart"), F.col("word").alias("item"), "n"))
            .unionByName(shown[2].select(F.lit(names[2]).alias("chart"),
                                         F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("item"),
                                         F.col("volume").alias("n"))))


@query
def k7_report_rows(spark, sf):
    rows = D.report_rows(mentions(spark, sf), lambda few: few_with_tweet(few, sf))
    return rows.withColumn("timestamp", stamp("timestamp", MICROS))


@query
def k8_dashboard_bundle(spark, sf):
    """The dashboard with a spike in the latest hour, so that there are anomalies to show."""
    parts = D.dashboard(with_spike(spark, sf), alert_state(spark, sf), seconds=HOUR)
    return D.dashboard_rows(parts)


@query
def k8_cube_by_batch(spark, sf):
    """The cube kept as a table by day, six batches merged into it, the third one twice."""
    path = scratch_folder(spark, "cube")
    for number, rows in enumerate(mention_chunks(spark, sf)):
        for _ in range(2 if number == 2 else 1):
            merge_batch(path, cube.CUBE, cube.cube(rows), number, jobs.day_of("minute"), cube.merged)
    kept = read_state(spark, path, cube.CUBE)
    return kept.groupBy("brand", "sentiment").agg(F.count("*").alias("minutes"), F.sum("n").alias("n"), F.sum("polarity_micro").alias("polarity_micro"),
                                                  F.sum("confidence_n").alias("scored"))


@query
def k9_sink_audit(spark, sf):
    path = scratch_folder(spark, "k9")
    log = audit_log(spark, sf).withColumn("detail", F.rpad("detail", 2500, "x"))
    sinks.append_audit(log, path)
    back = spark.read.schema(schemas.AUDIT).parquet(path)
    return back.select("id", "user_id", "event", F.length("detail").alias("chars"))
