"""Filters, paging, sources, alerts and display: hand cases."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from murmur import schemas
from murmur.functions import display
from murmur.operators import aggregates, alerts, filters, paging, replay, search
from murmur.plans import dashboard
from murmur.sources import files, history, normalise

NOW = datetime(2026, 3, 1, 12, 0)
MENTION = ("mention_id BIGINT, timestamp TIMESTAMP, tweet STRING, brand STRING, username STRING, "
           "sentiment STRING, polarity DOUBLE, subjectivity DOUBLE, confidence DOUBLE")


def mention(i, ts=NOW, tweet="text", brand="Acme", label="Neutral", polarity=0.0):
    return (i, ts, tweet, brand, "u", label, polarity, 0.5, 0.72)


def frame(spark, rows):
    return spark.createDataFrame(rows, MENTION)


def ids(df):
    return sorted(r["mention_id"] for r in df.collect())


def test_days_filter(spark):
    df = frame(spark, [mention(1), mention(2, NOW - timedelta(days=7)),
                       mention(3, NOW - timedelta(days=7, seconds=1)), mention(4, None)])
    assert ids(filters.last_days(df, 7)) == [1, 2]
    assert ids(filters.last_days(df, "30")) == [1, 2, 3]
    assert ids(filters.last_days(df, 8)) == [1, 2, 3, 4]
    assert ids(filters.last_days(df.filter("timestamp IS NULL"), 7)) == [4]


def test_days_count_back_from_what_the_other_filters_keep(spark):
    df = frame(spark, [mention(1, brand="B"), mention(2, NOW - timedelta(days=10)),
                       mention(3, NOW - timedelta(days=16))])
    assert ids(filters.filtered(df, brand="acme", days=7)) == [2, 3]


def test_search_is_literal_and_looks_at_brand(spark):
    df = frame(spark, [mention(1, tweet="100% Off"), mention(2, tweet="100 off"), mention(3, brand="OFFice")])
    assert ids(filters.filtered(df, search="100%")) == [1]
    assert ids(filters.filtered(df, search="off")) == [1, 2, 3]
    assert ids(filters.filtered(df, sentiment="POSITIVE")) == []


def test_paging(spark):
    df = frame(spark, [mention(i, NOW - timedelta(minutes=i // 2)) for i in range(100)])
    assert paging.page(df, 9).count() == 4
    info = paging.page_info(df, df, 9).first()
    assert (info["total"], info["pages"], info["available_total"]) == (100, 9, 100)
    assert paging.page_info(df.filter("false"), df).first()["pages"] == 1
    second = paging.page(df, 2).collect()
    last = paging.page(df, 1).collect()[-1]
    assert paging.page_after(df, str(last["timestamp"]), last["mention_id"]).collect() == second
    with pytest.raises(ValueError):
        paging.page(df, 1, 101)


def test_spreadsheet_cells(spark):
    cells = ["=1+1", "  @x", "\t-3", "a=b", "", None, "+", "\r\n=x"]
    df = spark.createDataFrame([(c,) for c in cells], "c STRING")
    got = [r[0] for r in df.select(display.spreadsheet_safe(F.col("c"))).collect()]
    assert got == ["'=1+1", "'  @x", "'\t-3", "a=b", "", None, "'+", "'\r\n=x"]


def test_relative_age_and_snippet(spark):
    stamps = [NOW, NOW - timedelta(minutes=59), NOW - timedelta(hours=3), NOW + timedelta(hours=1), None]
    df = spark.createDataFrame([(s,) for s in stamps], "t TIMESTAMP")
    ages = [r[0] for r in df.select(display.relative_age(F.col("t"), F.lit(NOW))).collect()]
    assert ages == ["now", "59m ago", "3h ago", "now", "recently"]
    text = spark.createDataFrame([("<a> & \"b\"\n" + "x" * 400,)], "t STRING")
    assert text.select(display.report_snippet(F.col("t"))).first()[0] == "&lt;a&gt; &amp; &quot;b&quot; " + "x" * 290


def test_normalise(spark):
    raw = spark.createDataFrame(
        [("", "x", None, "", "abc", "2026-01-01T10:00:00Z"), ("", "", "", "E", "0.5", "never"),
         ("t", "", "B", "E", "0.5", "2026-01-01 12:00:00+02:00")],
        "tweet STRING, tweet_text STRING, brand STRING, entity STRING, polarity STRING, timestamp STRING")
    rows = normalise.normalise(raw).orderBy("tweet").collect()
    assert [(r["tweet"], r["brand"], r["polarity"], r["sentiment"], r["username"]) for r in rows] == [
        ("t", "B", 0.5, "Neutral", "community"), ("x", "Other", 0.0, "Neutral", "community")]
    assert {r["timestamp"] for r in rows} == {datetime(2026, 1, 1, 10)}


def test_impute_from_label(spark):
    raw = spark.createDataFrame([(10, "A", "positive", "x"), (20, "", "Irrelevant", "y"), (30, "B", "NEGATIVE", "z")],
                                "tweet_id BIGINT, entity STRING, sentiment_label STRING, tweet_text STRING")
    rows = normalise.impute_from_label(raw, "tweet_id", F.lit(NOW)).orderBy("tweet_id").collect()
    assert [(r["sentiment"], r["polarity"], r["brand"]) for r in rows] == [
        ("Positive", 0.42, "A"), ("Neutral", 0.0, "Other"), ("Negative", -0.42, "B")]
    assert [r["timestamp"] for r in rows] == [NOW - timedelta(minutes=m) for m in (2, 1, 0)]


def write(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder / name)


def test_csv_detection(spark, tmp_path):
    headed = write(tmp_path, "a.csv", 'tweet_id,Entity,tweet_text\n1,A,"say ""hi"", you\nall"\n2,B\n3,C,x,over,long\n')
    rows = files.read_detected_csv(spark, headed).orderBy("tweet_id").collect()
    assert [tuple(r) for r in rows] == [("1", "A", 'say "hi", you\nall'), ("2", "B", None)]
    bare = write(tmp_path, "b.csv", "1,A,Positive,first,more\n2,B,Negative,second,less\n")
    df = files.read_detected_csv(spark, bare)
    assert df.columns == [*schemas.RAW_COLUMNS, "extra_0"] and df.count() == 2
    assert files.text_column(df) == "tweet_text"
    latin = write(tmp_path, "c.csv", "tweet\ncafé\n".encode("latin-1"))
    assert files.read_detected_csv(spark, latin).first()[0] == "café"
    with pytest.raises(ValueError):
        files.read_detected_csv(spark, write(tmp_path, "d.csv", "brand,x\n1,2\n"))


def test_result_folder_and_snapshots(spark, tmp_path):
    header = "timestamp,tweet,polarity\n"
    parts = tmp_path / "parts"
    write(parts, "p1.csv", header + "2026-01-01 00:00:00,a,0.5\nnever,b,1\n")
    write(parts, "p2.csv", header + '2026-01-02 00:00:00,"c, d",x\n')
    rows = files.read_result_folder(spark, str(parts)).orderBy("timestamp").collect()
    assert [(r["tweet"], r["polarity"]) for r in rows] == [("a", 0.5), ("c, d", None)]
    whole = write(tmp_path / "w", "all.csv", header + "2026-01-03 00:00:00,z,1\n")
    assert files.read_result_folder(spark, str(tmp_path / "none"), whole).first()["tweet"] == "z"
    with pytest.raises(FileNotFoundError):
        files.read_result_folder(spark, str(tmp_path / "none"))
    import os
    os.utime(parts / "p1.csv", (1, 1))
    both = spark.read.csv(str(parts), header=True)
    assert [r["tweet"] for r in files.newest_file_rows(both).collect()] == ['c, d']
    old = spark.read.csv(str(parts / "p1.csv"), header=True)
    assert files.newest_of(old, both) is both
    assert files.newest_of(both, old).count() == 1
    assert files.rows_or_history(old.filter("false"), both) is both


def test_alert_lifecycle(spark):
    def at(minute):
        return NOW + timedelta(minutes=minute)
    log = spark.createDataFrame(
        [("a", "t1", "d1", "High", "Open", at(0)), ("a", "t2", "d2", "Medium", "Resolved", at(2)),
         ("b", "t", "d", "High", "Open", at(1))], schemas.ALERT_LOG)
    state = alerts.fold_alert_log(log)
    a = state.filter("alert_id = 'a'").first()
    assert (a["title"], a["severity"], a["status"], a["created_at"], a["updated_at"]) == ("t2", "Medium", "Open", at(0), at(2))
    actions = spark.createDataFrame([("a", "acknowledge", at(3)), ("a", "resolve", at(4)), ("c", "resolve", at(5)),
                                     ("b", "explode", at(6))], "alert_id STRING, action STRING, at TIMESTAMP")
    moved = alerts.apply_transitions(state, actions)
    assert {r["alert_id"]: r["status"] for r in moved.collect()} == {"a": "Resolved", "b": "Open"}
    again = alerts.upsert_alerts(moved, log.filter("alert_id = 'a'").withColumn("at", F.lit(at(9))))
    a = again.filter("alert_id = 'a'").first()
    assert (a["status"], a["created_at"], a["updated_at"]) == ("Resolved", at(0), at(9))
    loose = alerts.loose_statuses(state, actions)
    assert [(r["alert_id"], r["status"]) for r in loose.collect()] == [("c", "Resolved")]
    assert alerts.unknown_actions(actions).count() == 1
    now = spark.createDataFrame([("a",), ("c",), ("z",)], "id STRING")
    shown = alerts.status_overlay(now, loose.filter("false"), moved, loose)
    assert {r["id"]: r["status"] for r in shown.collect()} == {"a": "Resolved", "c": "Resolved", "z": "Open"}
    union = alerts.all_alerts(now, state.select(F.col("alert_id").alias("id")), now)
    assert sorted(r["id"] for r in union.collect()) == ["a", "b", "c", "z"]


def test_negative_share_is_strict(spark):
    rows = [mention(i, label="Negative" if i < 3 else "Positive") for i in range(10)]
    assert alerts.negative_share_alert(frame(spark, rows)).count() == 0
    rows[3] = mention(3, label="Negative")
    assert alerts.negative_share_alert(frame(spark, rows)).first()["detail"] == "40% of the current stream is negative."


def test_aggregates_of_nothing(spark):
    none = frame(spark, [])
    shares = aggregates.kpi_shares(aggregates.kpi_counts(none)).first()
    assert (shares["total"], shares["positive_pct"], shares["positive_label"]) == (0, 0.0, "0.0%")
    assert [r["n"] for r in aggregates.sentiment_distribution(none).collect()] == [0, 0, 0]
    assert aggregates.resample_minute(none).count() == 0


def test_half_even_shares_and_unknown_labels(spark):
    rows = [mention(i, label="Negative" if i == 0 else "Irrelevant") for i in range(16)]
    shares = aggregates.kpi_shares(aggregates.kpi_counts(frame(spark, rows))).first()
    assert (shares["negative_pct"], shares["neutral"], shares["total"]) == (6.2, 0, 16)
    eighth = frame(spark, rows[:8])
    assert aggregates.by_brand(eighth).first()["negative"] == 12


def test_timeline_and_gaps(spark):
    df = frame(spark, [mention(1), mention(2, NOW + timedelta(days=1)), mention(3, NOW + timedelta(minutes=3)), mention(4, None)])
    line = {r["time"]: r["neutral"] for r in aggregates.timeline_minute_of_day(df).collect()}
    assert line == {"12:00": 2, "12:03": 1, "—": 1}
    minutes = aggregates.resample_minute(df.filter("mention_id IN (1, 3)")).orderBy("minute").collect()
    assert [(r["volume"], r["avg_polarity"]) for r in minutes] == [(1, 0.0), (0, None), (0, None), (1, 0.0)]


def test_rolling_average(spark):
    df = frame(spark, [mention(i, NOW + timedelta(seconds=s), polarity=p)
                       for i, (s, p) in enumerate([(0, 0.4), (0, 0.2), (300, 0.9), (301, -0.1), (20000, 1.0)])])
    rows = aggregates.rolling_avg_polarity(df).orderBy("second").collect()
    assert [(r["n"], r["rolling_avg_polarity"]) for r in rows] == [(2, 0.3), (3, 0.5), (2, 0.4), (1, 1.0)]


def test_history_takes_each_row_once(spark, tmp_path):
    path = str(tmp_path / "history")
    df = frame(spark, [mention(2), mention(1, brand="first"), mention(3, tweet="other")])
    history.insert_unseen(df, path, "mention_id")
    history.insert_unseen(df.unionByName(frame(spark, [mention(4, NOW + timedelta(days=1))])), path, "mention_id")
    rows = history.read_history(spark, path).collect()
    assert len(rows) == 3 and sum(r["brand"] == "first" for r in rows) == 1


def test_history_stores_a_text_once(spark, tmp_path):
    """However many rows, loads and writers share a text; rows of a table from before texts lay apart keep theirs."""
    path = str(tmp_path / "history")
    texts = ["said by many", "", None, "said once"]
    rows = [mention(i, NOW + timedelta(hours=i), tweet=texts[min(i % 4, 2 + i // 39)]) for i in range(40)]
    old = history.with_hash(frame(spark, rows[:3])).withColumn("day", F.to_date("timestamp")).select(*history.COLUMNS)
    old.write.partitionBy("day").parquet(path)
    assert history.read_history(spark, path).count() == 3
    for load in (rows[:20], rows[10:], rows):
        history.insert_unseen(frame(spark, load), path, "mention_id")
    stored = spark.read.parquet(f"{path}/_texts")
    assert sorted(r["text"] for r in stored.collect()) == ["", "said by many", "said once"]
    stored.limit(1).write.mode("append").parquet(f"{path}/_texts")  # as a load leaves it that failed before its rows
    assert history.stored_rows(spark, path).filter("tweet IS NOT NULL").count() == 2
    got = sorted((r["timestamp"], r["tweet"]) for r in history.read_history(spark, path).collect())
    assert [t for _, t in got] == [r["tweet"] for r in frame(spark, rows).orderBy("timestamp").collect()] and len(got) == 40


def test_replay_and_spike(spark):
    source = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "row_id BIGINT, tweet STRING")
    ticks = spark.range(7).select(F.col("id").alias("value"), F.lit(NOW).alias("timestamp"))
    rows = replay.replay(ticks, source, 3).orderBy("value").collect()
    assert "".join(r["tweet"] for r in rows) == "abcabca"
    with pytest.raises(ValueError):
        replay.paced(ticks, 9)
    df = frame(spark, [mention(1), mention(2, label="Negative", tweet="bad"), mention(3, label="Negative", tweet="worse")])
    spike = replay.spike_rows(df, 5, F.lit(NOW))
    assert sorted(r["tweet"] for r in spike.collect()) == ["[DEMO SPIKE] bad"] * 3 + ["[DEMO SPIKE] worse"] * 2
    assert replay.spike_alerts(spike).count() == 5
    assert replay.spike_rows(df.filter("mention_id = 1"), 2, F.lit(NOW)).first()["brand"] == "Demo brand"


@pytest.mark.parametrize("n", [0, 1, 5000, 5001, 5500, 6000, 6001, 12345])
def test_buffer_size(n):
    size = 0
    for _ in range(n):
        size += 1
        if size > 5000:
            size -= 1000
    assert replay.retained_rows(n) == size


def test_exports(spark, tmp_path):
    df = frame(spark, [mention(1, tweet='=cmd, "x"\ny'), mention(2, brand="Other")])
    dashboard.export_csv(df, str(tmp_path / "out"), brand="Acme")
    back = spark.read.options(**files.DIALECT, header="true").csv(str(tmp_path / "out")).collect()
    assert len(back) == 1 and back[0]["tweet"] == '\'=cmd, "x"\ny'
    assert tuple(back[0].asDict()) == schemas.MENTION_COLUMNS
    parts = dashboard.dashboard(df, spark.createDataFrame([("a", "Open")], "id STRING, status STRING"), brand="acme")
    assert parts["figures"].first()["total"] == 1
    assert parts["gauges"].first()["available_total"] == 2
    assert [r["brand"] for r in parts["brands_list"].collect()] == ["Acme"]
    report = dashboard.report_rows(df, lambda few: few).collect()
    assert [r["mention_id"] for r in report] == [2, 1] and report[0]["polarity"] == "0.00"


def test_far_pages_are_those_of_offset(spark):
    """Minutes with many rows, days without any, and rows without a timestamp at the end."""
    rng = random.Random(4)
    rows = [(i, None if i % 17 == 0 else datetime(2026, 1, 1) + timedelta(days=rng.choice([0, 0, 3, 9]), seconds=rng.randrange(400))) for i in range(300)]
    df = spark.createDataFrame(rows, "mention_id BIGINT, timestamp TIMESTAMP")
    counts = df.groupBy(F.date_trunc("minute", "timestamp").alias("minute")).agg(F.count("*").alias("n"))
    for number in (1, 2, 7, 20, 24, 25, 26, 40):
        assert paging.far_page(df, counts, number, 12).collect() == paging.page(df, number, 12).collect()


def test_index_search_is_a_scan(spark, tmp_path):
    texts = [(i, f"Mention {i} of Öl, 100% naïve \U0001F600 x") for i in range(200)] + [(200, None), (201, ""), (202, "ab"), (203, "rare NEEDLE here"), (204, "nee dle")]
    df = spark.createDataFrame(texts, "id BIGINT, tweet STRING")
    search.build_index(df, str(tmp_path), "id", "tweet", 32)
    for needle in ("needle", "öl, 100%", "\U0001F600 x", "ab", "mention 19", "no such", "é", "İ", "%"):
        found = {r["id"] for r in search.search(spark, str(tmp_path), needle, "tweet").collect()}
        assert found == {r["id"] for r in df.filter(filters.holds(F.col("tweet"), needle)).collect()}, needle
    assert search.candidates(spark, str(tmp_path), "needle").count() <= 2
    plan = search.search(spark, str(tmp_path), "needle", "tweet")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan  # only the candidates' folders are read


def test_csv_copies_are_packed_and_cut_by_rows(spark, monkeypatch):
    """A task's rows go to several files, as one with line breaks in its cells is read whole; a result folder reads both kinds."""
    from murmur.plans import catalog
    from murmur.sources import files
    from murmur.streaming import sinks
    monkeypatch.setitem(sinks.PACKED, "maxRecordsPerFile", "10")
    rows = spark.range(45).select(F.lit("2024-01-01 00:00:00").alias("timestamp"), F.concat(F.lit('a "b",\n'), F.col("id").cast("string")).alias("tweet")).coalesce(1)
    path = catalog.csv_copy(spark, "", rows, "cut", True)
    parts = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    assert len(parts) == 5 and all(p["path"].endswith(".csv.gz") for p in parts)
    rows.limit(3).write.mode("append").csv(path, header=True, escape='"', quoteAll=True)
    back = [r["tweet"] for r in files.read_result_folder(spark, path).collect()]
    assert len(back) == 48 and set(back) == {f'a "b",\n{i}' for i in range(45)}
