"""Alert rules over all mentions, the alert log and its states.

The current state is a fold of an append-only log, a group-by with a partial aggregate, or
a stored table that batches of the log are merged into; no row is ever updated in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.fixed import ratio
from murmur.schemas import ALERTS
from murmur.sources.states import hash_bucket, merge_batch, read_state

# Actions on an alert and the status each leads to.
ACTIONS = {"acknowledge": "Acknowledged", "resolve": "Resolved"}
OPEN = "Open"


def negative_share_alert(mentions: DataFrame, share: float = S.NEGATIVE_SHARE) -> DataFrame:
    """One High alert when more than `share` of the rows are negative, else no row."""
    counts = mentions.agg(F.count("*").alias("total"),
                          F.count_if(F.col("sentiment") == "Negative").alias("negative"))
    percent = ratio(F.col("negative") * 100, F.col("total"), 0).cast("bigint").cast("string")
    return counts.filter(F.col("negative") > F.col("total") * share).select(
        F.lit("negative-share").alias("id"), F.lit(S.SHARE_TITLE).alias("title"),
        F.concat(percent, F.lit(S.SHARE_REASON)).alias("detail"),
        F.lit("High").alias("severity"))


def as_alerts(window_alerts: DataFrame) -> DataFrame:
    """Detector rows in the shape of the alert list."""
    return window_alerts.select("id", "title", F.col("reason").alias("detail"), "severity",
                                F.replace(F.substring("window", 1, 16), F.lit("T"), F.lit(" ")).alias("time"))


def fold_alert_log(log: DataFrame) -> DataFrame:
    """Current alerts: newest title, detail and severity; first status and creation time.

    Of entries with one time the largest is the newest and the smallest the first, so
    that the state does not depend on the order they were read in.
    """
    newest = F.max(F.struct("at", "title", "detail", "severity"))
    return (log.groupBy("alert_id")
            .agg(newest.alias("n"), F.min(F.struct("at", "status")).alias("f"),
                 F.min("at").alias("created_at"), F.max("at").alias("updated_at"))
            .select("alert_id", "n.title", "n.detail", "n.severity", "f.status", "created_at", "updated_at"))


def upsert_alerts(state: DataFrame, batch: DataFrame) -> DataFrame:
    """State after saving a batch of alerts: known ids keep their status and creation time."""
    new = batch.select("alert_id", F.struct("title", "detail", "severity", "status", "at").alias("b"))
    old = state.select("alert_id", F.struct("title", "detail", "severity", "status",
                                            "created_at", "updated_at").alias("s"))
    latest = new.groupBy("alert_id").agg(
        F.max(F.struct("b.at", "b.title", "b.detail", "b.severity")).alias("b"),
        F.min(F.struct("b.at", "b.status"))["status"].alias("first_status"), F.min("b.at").alias("first_at"))
    return old.join(latest, "alert_id", "full_outer").select(
        "alert_id", *[F.coalesce(f"b.{c}", f"s.{c}").alias(c) for c in ("title", "detail", "severity")],
        F.coalesce("s.status", "first_status").alias("status"),
        F.coalesce("s.created_at", "first_at").alias("created_at"),
        F.coalesce("b.at", "s.updated_at").alias("updated_at"))


def store_alerts(batch: DataFrame, batch_id: int, path: str) -> bool:
    """Merge a batch of the alert log into the stored alerts; a batch that is in them changes nothing."""
    return merge_batch(path, ALERTS, batch.select("alert_id", "title", "detail", "severity", "status", "at"), batch_id,
                       hash_bucket("alert_id"), upsert_alerts)


def store_transitions(actions: DataFrame, batch_id: int, path: str) -> bool:
    """Merge a batch of actions into the stored alerts, under the next batch id."""
    return merge_batch(path, ALERTS, actions, batch_id, hash_bucket("alert_id"), apply_transitions)


def stored_alerts(spark: SparkSession, path: str) -> DataFrame:
    return read_state(spark, path, ALERTS)


def latest_status(actions: DataFrame) -> DataFrame:
    """Newest status per alert of a log (alert_id, action, at); unknown actions are no error here."""
    status = F.when(F.col("action") == "acknowledge", ACTIONS["acknowledge"]) \
              .when(F.col("action") == "resolve", ACTIONS["resolve"])
    return (actions.withColumn("status", status).filter("status IS NOT NULL")
            .groupBy("alert_id").agg(F.max(F.struct("at", "status"))["status"].alias("status"), F.max("at").alias("at")))


def unknown_actions(actions: DataFrame) -> DataFrame:
    return actions.filter(~F.coalesce(F.col("action").isin(list(ACTIONS)), F.lit(False)))


def apply_transitions(alerts: DataFrame, actions: DataFrame) -> DataFrame:
    """Alerts after the logged actions on them."""
    moved = latest_status(actions).select("alert_id", F.col("status").alias("to"), F.col("at").alias("moved_at"))
    return alerts.join(moved, "alert_id", "left").select(
        "alert_id", "title", "detail", "severity", F.coalesce("to", "status").alias("status"),
        "created_at", F.coalesce("moved_at", "updated_at").alias("updated_at"))


def loose_statuses(alerts: DataFrame, actions: DataFrame) -> DataFrame:
    """Statuses of ids that have no alert row."""
    return latest_status(actions).join(alerts.select("alert_id"), "alert_id", "left_anti")


def status_overlay(alerts: DataFrame, session: DataFrame, stored: DataFrame,
                   loose: DataFrame) -> DataFrame:
    """Status of each alert: session before stored alert before loose status before Open."""
    for rank, source in enumerate((session, stored, loose)):
        # A source that lists an id twice must not double the alert.
        named = source.groupBy(F.col("alert_id").alias("id")).agg(F.max("status").alias(f"_status{rank}"))
        alerts = alerts.join(named, "id", "left")
    return alerts.withColumn("status", F.coalesce("_status0", "_status1", "_status2", F.lit(OPEN))) \
                 .drop("_status0", "_status1", "_status2")


def not_listed(alerts: DataFrame, *listed: DataFrame) -> DataFrame:
    """Alerts whose id no other list has."""
    for other in listed:
        alerts = alerts.join(other.select("id"), "id", "left_anti")
    return alerts


def all_alerts(current: DataFrame, stored: DataFrame, session: DataFrame) -> DataFrame:
    """Current alerts, then stored ones, then session ones, each id once."""
    kept = not_listed(stored, current)
    return (current.unionByName(kept, allowMissingColumns=True)
            .unionByName(not_listed(session, current, kept), allowMissingColumns=True))


def current_alerts(mentions: DataFrame, detected: DataFrame) -> DataFrame:
    """The share rule's alert and the detector's, in the shape of the alert list."""
    share = negative_share_alert(mentions).withColumn("time", F.lit("Now"))
    return share.unionByName(as_alerts(detected))


def save_current(saved: DataFrame, current: DataFrame, at) -> DataFrame:
    """Saved alerts after the current ones were saved at one moment; new ones are Open."""
    return upsert_alerts(saved, current.select(
        F.col("id").alias("alert_id"), "title", "detail", "severity", F.lit(OPEN).alias("status"), at.alias("at")))


def alert_list(current: DataFrame, saved: DataFrame, actions: DataFrame, session: DataFrame) -> DataFrame:
    """The alert list: current alerts, then saved ones, then those of the session, each id once.

    A current alert's status is that of the latest action on it, else the saved one, else
    Open. `saved` is a state as `save_current` returns it, `session` has id, title, detail,
    severity and status.
    """
    moved = latest_status(actions)
    now = status_overlay(current, moved, saved, moved)
    kept = apply_transitions(saved, actions).select(
        F.col("alert_id").alias("id"), "title", "detail", "severity", "status",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm").alias("time"))
    return all_alerts(now, kept, session.withColumn("time", F.lit("Now")))


def gauges(mentions: DataFrame, alerts: DataFrame) -> DataFrame:
    opened = alerts.agg(F.count_if(F.col("status") == OPEN))
    return mentions.agg(F.count("*").alias("records_loaded")).withColumn("open_alerts", opened.scalar())


def timeline_marks(timeline: DataFrame, alerts: DataFrame) -> DataFrame:
    """Timeline buckets an alert falls on; alerts that meet no bucket are left out."""
    marks = alerts.select(F.substring("window", 12, 5).alias("time"), "id", "severity")
    return timeline.join(marks, "time")
