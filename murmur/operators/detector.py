"""All rules, on the latest window or on every one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from murmur import settings as S
from murmur.operators.isolation import isolation_alerts, isolation_scores, latest_isolation
from murmur.operators.windows import all_window_alerts, latest_window_alerts, window_metrics


def score_windows(facts: DataFrame, seconds: int = S.WINDOW_SECONDS) -> DataFrame:
    """Alerts of the latest window by the baseline rules and the forest. `facts` is read several times: settle it."""
    forest = latest_isolation(window_metrics(facts), seconds)
    return latest_window_alerts(facts, seconds).unionByName(isolation_alerts(forest))


def score_all_windows(facts: DataFrame, seconds: int = S.WINDOW_SECONDS) -> DataFrame:
    """Alerts of every window by the baseline rules and the forest of the windows before it. `facts` is read several times."""
    forest = isolation_scores(window_metrics(facts), seconds)
    return all_window_alerts(facts, seconds).unionByName(isolation_alerts(forest))
