"""The dashboard, export, chart and report jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur import schemas
from murmur import settings as S
from murmur.functions.display import html_escape, report_snippet
from murmur.functions.fixed import plain
from murmur.operators import aggregates as A
from murmur.operators import cube as C
from murmur.operators import filters
from murmur.operators.paging import NEWEST, latest
from murmur.operators.detector import score_windows
from murmur.session import settle
from murmur.streaming.sinks import CSV, safe_columns


def dashboard(mentions: DataFrame, alerts: DataFrame, brand: str = "all", search: str = "",
              days: int | str = "all", seconds: int = S.WINDOW_SECONDS) -> dict[str, DataFrame]:
    """The parts of the dashboard.

    Figures, brands, timeline and anomalies follow the filters; the brand list and the
    gauges cover all mentions. All parts but `filtered` come from one cube, settled once, of
    the filtered rows, and a second one of all rows where a filter is set.
    """
    rows = filters.filtered(mentions, brand, "all", search, days)
    return {"filtered": rows, **cube_parts(
        settle(C.cube(rows), "cube"), alerts, seconds,
        None if (brand, search, days) == ("all", "", "all") else settle(C.cube(mentions), "cube"))}


def cube_parts(rows: DataFrame, alerts: DataFrame, seconds: int = S.WINDOW_SECONDS, every: DataFrame | None = None) -> dict[str, DataFrame]:
    """The parts from a cube of the rows shown and, if that is another, one of all mentions. Cubes are read several times."""
    every = rows if every is None else every
    return {
        "figures": C.figures(rows),
        "brands": C.by_brand(rows),
        "timeline": C.timeline_minute_of_day(rows),
        "anomalies": score_windows(settle(C.window_facts(rows, seconds), "facts"), seconds),
        "brands_list": filters.brands_list(every),
        "gauges": every.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("available_total")).withColumn(
            "active_alerts", alerts.agg(F.count_if(F.col("status") == "Open")).scalar()),
    }


def dashboard_rows(parts: dict[str, DataFrame]) -> DataFrame:
    """The numbers of the dashboard as one long table (section, item, metric, value)."""
    def long(section: str, df: DataFrame, item, columns: list[str]) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]
        return df.select(F.lit(section).alias("section"), item.alias("item"), F.inline(F.array(*cells)))
    figures = ["total", "positive", "negative", "neutral", "positive_pct", "negative_pct",
               "avg_polarity", "tweets_per_min"]
    return (long("figures", parts["figures"], F.lit(""), figures)
            .unionByName(long("brands", parts["brands"], F.col("brand"), ["total", "polarity", "negative"]))
            .unionByName(long("timeline", parts["timeline"], F.col("time"),
                              ["positive", "negative", "neutral", "polarity"]))
            .unionByName(long("anomalies", parts["anomalies"], F.col("id"), ["score"]))
            .unionByName(long("brands_list", parts["brands_list"].withColumn("listed", F.lit(1)), F.col("brand"), ["listed"]))
            .unionByName(long("gauges", parts["gauges"], F.lit(""), ["available_total", "active_alerts"])))


def export_rows(mentions: DataFrame, **wanted) -> DataFrame:
    """Filtered rows in the eight export columns, safe to open in a spreadsheet."""
    rows = filters.filtered(mentions, **wanted).select(*schemas.MENTION_COLUMNS)
    return rows.select(*safe_columns(rows))


def export_csv(mentions: DataFrame, path: str, **wanted) -> None:
    export_rows(mentions, **wanted).write.mode("overwrite").options(**CSV).csv(path)


def chart_datasets(mentions: DataFrame, words: DataFrame) -> dict[str, DataFrame]:
    """The inputs of the three charts over dated mentions; `words` has (word, n), n over the same mentions."""
    dated = filters.drop_bad_timestamp(mentions)
    return {"sentiment_distribution": A.sentiment_distribution(dated),
            "word_frequency": A.count_words(words), "time_series": A.resample_minute(dated)}


def write_charts(charts: dict[str, DataFrame], folder: str) -> None:
    for name, rows in charts.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")


def report_rows(mentions: DataFrame, with_tweet, order=NEWEST) -> DataFrame:
    """The newest rows as the report prints them; `with_tweet` adds the text to few rows."""
    rows = with_tweet(latest(mentions, S.REPORT_ROWS, order))
    return rows.select(
        *order, html_escape(F.col("brand")).alias("brand"), html_escape(F.col("sentiment")).alias("sentiment"),
        plain(F.col("polarity"), 2).alias("polarity"), report_snippet(F.col("tweet")).alias("snippet"))
