"""Streams: same rows as the batch jobs, once each, whatever is repeated."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from murmur.operators.scoring import default_lexicon, score_batch
from murmur.operators.detector import score_all_windows
from murmur.operators.windows import window_facts
from murmur.sources import history
from murmur.streaming import ingest, jobs, sinks

ONCE = {"availableNow": True}
RAW = "value STRING, timestamp TIMESTAMP"
START = datetime(2026, 1, 1, 10, 0)


def messages(spark, n=40):
    rows = spark.createDataFrame(
        [(i, ["love it", "worst game", "a box", "=sum"][i % 4], "Acme" if i % 3 else None, " ",
          START + timedelta(seconds=20 * i)) for i in range(n)],
        "tweet_id BIGINT, tweet_text STRING, brand STRING, username STRING, at TIMESTAMP")
    built = ingest.build_messages(rows, F.col("at")).select("value", F.lit(START).alias("timestamp"))
    return built.unionByName(spark.createDataFrame([("{bad", START), ('{"tweet_id": 1}', START)], RAW))


def stream_of(spark, rows, folder, files=1):
    rows.repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(folder)


def test_parse_and_quarantine(spark):
    raw = messages(spark)
    parsed = ingest.parse_json_payload(raw)
    assert parsed.count() == 40
    assert {r["username"] for r in parsed.collect()} == {"community"}
    assert sorted(r["json_value"] for r in ingest.malformed(raw).collect()) == ['{"tweet_id": 1}', "{bad"]


def test_topic_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.read_topic(spark, "localhost:9092", "topic")


def test_all_sinks_hold_each_row_once(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    lexicon = default_lexicon(spark)
    dated = jobs.dated_mentions(ingest.parse_json_payload(stream_of(spark, messages(spark), source, 3)))
    sinks.all_sinks(dated, lexicon, base, console=True, **ONCE).awaitTermination()
    table = spark.read.parquet(f"{base}/mentions")
    assert table.count() == 40 and table.select("tweet_id").distinct().count() == 40
    csv = spark.read.csv(f"{base}/csv", header=True, escape='"')
    assert csv.filter("tweet = \"'=sum\"").count() == 10
    assert spark.read.parquet(f"{base}/history").count() == 40
    live = spark.read.text(f"{base}/live").select(
        F.from_json("value", "batch_id BIGINT, tweets ARRAY<STRUCT<tweet_id: INT>>").alias("e"))
    assert live.select(F.sum(F.size("e.tweets"))).first()[0] == 40
    # The same files again, as after a lost checkpoint: the history stays as it is.
    sinks.all_sinks(jobs.dated_mentions(ingest.parse_json_payload(spark.readStream.schema(RAW).parquet(source))), lexicon,
                    str(tmp_path / "again"), **ONCE).awaitTermination()
    again = spark.read.parquet(f"{tmp_path}/again/mentions")
    history.insert_unseen(again.drop("batch_id"), f"{base}/history", "tweet_id")
    assert spark.read.parquet(f"{base}/history").count() == 40
    batch = score_batch(table.drop("clean_tweet", "polarity", "subjectivity", "sentiment", "confidence"), lexicon)
    columns = ["tweet_id", "polarity", "sentiment", "confidence"]
    assert sorted(batch.select(*columns).collect()) == sorted(table.select(*columns).collect())


def mention_folder(spark, folder, files=4):
    rows = [(i, START + timedelta(seconds=7 * i), "AB"[i % 2], "Negative" if i % 5 == 0 else "Positive", i % 9 / 10)
            for i in range(300)]
    df = spark.createDataFrame(rows, "mention_id BIGINT, timestamp TIMESTAMP, brand STRING, sentiment STRING, polarity DOUBLE")
    df.repartitionByRange(files, "mention_id").write.parquet(folder)
    return df


def test_windows_of_stream_and_batch_agree(spark, tmp_path):
    batch = mention_folder(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    facts = jobs.window_fact_stream(stream, 60, "1 hour")
    jobs.alert_job(facts, str(tmp_path / "facts"), str(tmp_path / "alerts"), str(tmp_path / "cp"), **ONCE).awaitTermination()
    got = jobs.current_facts(spark.read.parquet(str(tmp_path / "facts")))
    assert sorted(got.collect()) == sorted(window_facts(batch).select(*got.columns).collect())
    assert spark.read.parquet(str(tmp_path / "alerts")).columns[0] == "alert_id"


def test_late_rows_are_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "mention_id BIGINT, timestamp TIMESTAMP, brand STRING, sentiment STRING, polarity DOUBLE"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(schema).parquet(str(folder))
        query = (jobs.window_fact_stream(stream, 60, "10 minutes").writeStream.outputMode("update").trigger(**ONCE)
                 .option("checkpointLocation", str(tmp_path / "cp"))
                 .foreachBatch(lambda d, b: sinks.write_batch(d, str(tmp_path / "facts"), b)).start())
        query.awaitTermination()
        return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])

    assert run([(1, START, "A", "Positive", 0.1), (2, START + timedelta(hours=1), "A", "Positive", 0.1)]) == 0
    assert run([(3, START, "A", "Positive", 0.1)]) > 0
    assert jobs.current_facts(spark.read.parquet(str(tmp_path / "facts"))).agg(F.sum("mentions")).first()[0] == 2


def test_console_and_csv(spark, tmp_path, capfd):
    source = str(tmp_path / "in")
    dated = jobs.dated_mentions(ingest.parse_json_payload(stream_of(spark, messages(spark), source)))
    sinks.to_console(dated, **ONCE).awaitTermination()
    sinks.append_csv(dated, default_lexicon(spark), str(tmp_path / "csv"), str(tmp_path / "cp"), **ONCE).awaitTermination()
    rows = spark.read.csv(str(tmp_path / "csv"), header=True)
    assert rows.count() == 40 and rows.filter("sentiment = 'Positive'").count() == 10


def test_live_batch_holds_every_row(spark):
    rows = spark.range(1000).select(F.col("id").alias("tweet_id"), F.timestamp_seconds(F.col("id") % 90).alias("timestamp"))
    envelopes = sinks.live_batch(rows.repartition(5), 7, 64).select(F.from_json(
        "value", "batch_id BIGINT, part BIGINT, tweets ARRAY<STRUCT<tweet_id: BIGINT, timestamp: TIMESTAMP>>").alias("e")).select("e.*").collect()
    assert all(e["batch_id"] == 7 and len(e["tweets"]) <= 64 for e in envelopes)
    seen = [(t["timestamp"], t["tweet_id"]) for e in sorted(envelopes, key=lambda e: e["part"]) for t in e["tweets"]]
    assert len(seen) == 1000 and seen == sorted(seen, reverse=True)
    assert sinks.live_batch(rows.filter("false"), 1).count() == 0


def test_history_keeps_undated_rows_once(spark, tmp_path):
    schema = ("mention_id INT, timestamp TIMESTAMP, tweet STRING, brand STRING, username STRING, sentiment STRING, "
              "polarity DOUBLE, subjectivity DOUBLE, confidence DOUBLE")
    rest = ("A", "u", "Neutral", 0.0, 0.0, 0.0)
    rows = spark.createDataFrame([(1, None, "a", *rest), (2, None, "b", *rest), (3, None, "a", *rest), (4, START, None, *rest),
                                  (5, START, "a", *rest), (6, None, None, *rest)], schema)
    for _ in range(2):
        history.insert_unseen(rows, str(tmp_path / "h"), "mention_id")
        assert history.read_history(spark, str(tmp_path / "h")).count() == 5


def test_alerts_of_every_window_a_batch_touches(spark, tmp_path):
    """A spike some windows before the end, all in one batch and spread over many."""
    hours = [(10 * h + i, START + timedelta(hours=h), "A", "Positive", 0.1) for h in range(40) for i in range(2 + h % 2)]
    spike = [(1000 + i, START + timedelta(hours=33), "A", "Negative", -0.8) for i in range(30)]
    rows = spark.createDataFrame(hours + spike, "mention_id BIGINT, timestamp TIMESTAMP, brand STRING, sentiment STRING, polarity DOUBLE")
    expected = {r["id"] for r in score_all_windows(window_facts(rows, 3600), 3600).collect()}
    assert len(expected) >= 3
    for name, chunks in (("one", 1), ("many", 5)):
        folder = str(tmp_path / name)
        for n in range(chunks):
            part = F.floor(F.timestamp_diff("HOUR", F.lit(START), F.col("timestamp")) * chunks / 40)
            rows.filter(part == n).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        facts = jobs.window_fact_stream(stream, 3600)
        jobs.alert_job(facts, f"{folder}-facts", f"{folder}-alerts", f"{folder}-cp", 3600, **ONCE).awaitTermination()
        assert {r["alert_id"] for r in spark.read.parquet(f"{folder}-alerts").collect()} == expected


def test_first_seen(spark, tmp_path):
    df = mention_folder(spark, str(tmp_path / "in"), 2).withColumn("tweet_hash", F.lit("x"))
    df.write.parquet(str(tmp_path / "h"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "h"))
    (jobs.first_seen(stream, "2 hours").writeStream.format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start()).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_csv_sinks_give_back_what_they_were_given(spark, tmp_path):
    """Outer blanks, quotes, line breaks, nulls and empty texts, and numbers without exponents."""
    from murmur.plans.dashboard import export_csv
    from murmur.sources.files import DIALECT
    texts = ["  lead and trail  ", "\tx", "", None, 'say "so", twice""', "two\nlines\r\nand\rmore", "'q", "\\", "\\N", ",", " ", "é漢", '"']
    numbers = [0.0008, -0.0001, 0.0, 1e-5, 1.25e-7, 0.1 + 0.2, None, 12345678.9, 1e15, -1.0, 1.7976931348623157e308, 5e-324, float("nan")]
    rows = [(START + timedelta(seconds=i), t, "B", "u", "Neutral", n, n, n) for i, (t, n) in enumerate(zip(texts, numbers))]
    frame = spark.createDataFrame(rows, "timestamp TIMESTAMP, tweet STRING, brand STRING, username STRING, sentiment STRING, "
                                        "polarity DOUBLE, subjectivity DOUBLE, confidence DOUBLE")
    export_csv(frame, str(tmp_path / "export"))
    sinks.write_batch(frame.select(*sinks.csv_columns(frame)), str(tmp_path / "sink"), 0, "csv", **sinks.CSV)
    for folder in ("export", "sink/batch_id=0"):
        back = spark.read.options(**DIALECT, header="true").csv(f"{tmp_path}/{folder}").orderBy("timestamp").collect()
        assert [r["tweet"] for r in back] == texts
        assert [repr(r["polarity"] and float(r["polarity"])) for r in back] == [repr(n) for n in numbers]
        assert [r["polarity"] for r in back[:5]] == ["0.0008", "-0.0001", "0.0", "0.00001", "0.000000125"]
        assert back[7]["polarity"] == "12345678.9" and back[8]["polarity"] == "1000000000000000.0"


def test_console_shows_every_row(spark, tmp_path):
    lines = []
    rows = stream_of(spark, messages(spark), str(tmp_path / "in"), 3)
    sinks.to_console(ingest.parse_json_payload(rows), lines.append, **ONCE).awaitTermination()
    assert len(lines) == 40 and all('"tweet_id"' in line for line in lines)


def test_stored_state_is_merged_once_and_compacted(spark, tmp_path):
    """Batches touch some buckets; a repeated batch, a batch that failed before its manifest, and readers of the one before."""
    from murmur.sources import states
    path, schema = str(tmp_path / "state"), "k BIGINT, day STRING, n BIGINT"

    def merge(old, new):
        return old.unionByName(new).groupBy("k", "day").agg(F.sum("n").alias("n"))

    def put(number, rows, **how):
        return states.merge_batch(path, schema, spark.createDataFrame(rows, schema), number, F.col("day"), merge, **how)

    def table(of=None):
        return sorted(map(tuple, (of or states.read_state(spark, path, schema)).collect()))
    assert table() == []
    assert put(0, [(1, "a", 5), (2, "b", 1)]) and not put(0, [(1, "a", 5), (2, "b", 1)])
    before = states.read_state(spark, path, schema)
    (tmp_path / "state" / "batch-1-left-by-a-lost-driver").mkdir()
    assert put(1, [(1, "a", 2), (3, "c", 1)])
    assert table() == [(1, "a", 7), (2, "b", 1), (3, "c", 1)] and table(before) == [(1, "a", 5), (2, "b", 1)]
    assert put(2, [(4, "d", 1)], drop=lambda day: day < "b")
    assert table() == [(2, "b", 1), (3, "c", 1), (4, "d", 1)]
    for number in range(3, 12):
        put(number, [(number, "d", 1)])
    assert len(table()) == 11 and len(states.manifest(spark, path)["buckets"]) == 3
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("batch-")]) <= 6  # however many batches came
    assert put(12, []) and len(table()) == 11


def test_facts_of_a_long_run_lie_in_few_files(spark, tmp_path):
    rows = spark.createDataFrame([(START + timedelta(hours=i), "A", 1, 0, 0, 0) for i in range(30)], jobs.schemas.WINDOW_FACTS)
    for number in range(6):
        jobs.merge_batch(str(tmp_path / "f"), jobs.schemas.WINDOW_FACTS, rows.withColumn("batch_id", F.lit(number).cast("bigint")), number,
                         jobs.day_of("window_start"), lambda old, new: jobs.newest_facts(old.unionByName(new)))
    stored = jobs.read_facts(spark, str(tmp_path / "f"))
    assert stored.count() == 30 and len(stored.inputFiles()) <= 2 and jobs.read_facts(spark, str(tmp_path / "f"), "2026-01-02").count() == 16


def live(spark, folder, rule, *frames):
    """What a keyed rule reports over frames, each run from its checkpoint."""
    from murmur.streaming import limits
    with limits.keyed_state(spark):
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(frame.schema).parquet(f"{folder}/in")
            (rule(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
             .trigger(**ONCE).start()).awaitTermination()
    return sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect()), key=repr)


ATTEMPTS = "id BIGINT, timestamp TIMESTAMP, user STRING, failed BOOLEAN"


def test_locks_of_attempts_in_one_second(spark, tmp_path):
    """Several attempts of an account share a second or a moment; their order is that of the batch job."""
    from murmur.operators import guards
    from murmur.streaming import limits
    rows = [(i, START + timedelta(seconds=i // 4, microseconds=i % 4 // 2), "abc"[i % 3], i % 11 > 0) for i in range(120)]
    rows += [(200 + i, START + timedelta(seconds=50 + i // 2), None, True) for i in range(6)]
    log = spark.createDataFrame(rows, ATTEMPTS)
    expected = sorted(map(tuple, guards.lockouts(log, "user", "id", F.col("failed"), 3, 10).dropna().collect()), key=repr)
    got = live(spark, str(tmp_path), lambda s: limits.locks(s, "user", "id", F.col("failed"), 3, 10),
               log.filter("timestamp < '2026-01-01 10:00:15'"), log.filter("timestamp >= '2026-01-01 10:00:15'"))
    assert [r for r in got if r[0]] == expected and len(expected) > 3
    assert [r[1] - r[2] for r in got if r[0] is None] == [-10]


def test_limiter_of_many_keys_in_few_buckets(spark, tmp_path, monkeypatch):
    """Keys that share a state are judged apart; spans go on over batches and past the end of others."""
    from murmur.operators import guards
    from murmur.streaming import limits
    monkeypatch.setattr(limits, "BUCKETS", 2)
    rows = [(i, START + timedelta(seconds=i // 8 * (40 if i % 7 == 0 else 1)), "abcdefg"[i % 7], True) for i in range(400)]
    log = spark.createDataFrame(rows, ATTEMPTS).sort("timestamp")
    expected = sorted(map(tuple, guards.sliding_window_refusals(log, "user", 2, 9).collect()), key=repr)
    got = live(spark, str(tmp_path), lambda s: limits.sliding_refusals(s, "user", 2, 9), log.filter("timestamp < '2026-01-01 10:00:20'"),
               log.filter("timestamp >= '2026-01-01 10:00:20'"))
    assert got == expected and len(expected) > 20


def test_console_rows_are_made_by_all_tasks_at_once(spark, tmp_path):
    """What is fetched partition by partition was stored before, and goes when it is printed."""
    read, shown = [], []
    rows = stream_of(spark, messages(spark), str(tmp_path / "in"), 3)
    before = sinks.print_rows
    try:
        sinks.print_rows = lambda batch, write: (read.extend(batch.inputFiles()), before(batch, write))
        sinks.to_console(ingest.parse_json_payload(rows), shown.append, **ONCE).awaitTermination()
    finally:
        sinks.print_rows = before
    assert len(shown) == 40 and read and all("/console-" in file for file in read)
    from pathlib import Path
    assert not any(Path(file.removeprefix("file:")).exists() for file in read)


def test_live_batch_is_stored_in_shares(spark, tmp_path, monkeypatch):
    """Packed, each row once and in order over all shares, with its own texts; a repeated batch replaces them."""
    monkeypatch.setattr(sinks, "LIVE_ROWS", 100)
    held = F.when(F.col("id") % 7 > 0, F.concat(F.lit("text "), (F.col("id") % 7).cast("string")))
    rows = spark.range(500).select(F.col("id").alias("tweet_id"), F.timestamp_seconds(F.col("id") % 90).alias("timestamp"), held.alias("tweet"),
                                   F.when(F.col("id") % 2 == 0, held).alias("clean_tweet")).repartition(3)
    for _ in range(2):
        sinks.write_live(rows, str(tmp_path), 7, 32)
    stored = spark.read.text(str(tmp_path))
    assert all(f.endswith(".txt.gz") for f in stored.inputFiles()) and sinks.texts_of(rows).count() == 13
    found = stored.select(F.from_json("value", "batch_id BIGINT, part BIGINT, tweets ARRAY<STRUCT<tweet_id: BIGINT, timestamp: TIMESTAMP, "
                                               "tweet: STRING, clean_tweet: STRING>>").alias("e")).select("e.*").collect()
    assert all(e["batch_id"] == 7 and 0 < len(e["tweets"]) <= 32 for e in found)
    seen = [tuple(t) for e in sorted(found, key=lambda e: e["part"]) for t in e["tweets"]]
    assert [(t[1], t[0]) for t in seen] == sorted(((t[1], t[0]) for t in seen), reverse=True)
    assert sorted(seen) == sorted(map(tuple, rows.collect()))


def test_rows_are_scored_without_a_shuffle_of_their_texts(spark):
    """A shuffle holds rows or texts, never both; null and empty texts stay apart."""
    import re
    rows = spark.createDataFrame([(i, [None, "", "love it", "worst game"][i % 4]) for i in range(40)], "tweet_id INT, tweet STRING")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = score_batch(rows, default_lexicon(spark))
        dealt = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", scored._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
        assert any("tweet_id#" in d for d in dealt) and not any("tweet_id#" in d and "tweet#" in d for d in dealt)
        assert sorted(map(str, scored.select("tweet_id", "tweet").collect())) == sorted(map(str, rows.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_history_rows_are_told_apart_without_other_texts(spark, tmp_path, monkeypatch):
    """A struct of a row holds no column that isn't stored; the order's column may be one of those."""
    dealt = []
    monkeypatch.setattr(history, "first_per_hash", lambda rows, order, old=history.first_per_hash: dealt.append(rows.columns) or old(rows, order))
    rows = spark.createDataFrame([(i, START + timedelta(seconds=i // 2), "same", "clean") for i in (3, 2, 1, 0)],
                                 "tweet_id INT, timestamp TIMESTAMP, tweet STRING, clean_tweet STRING").withColumns(
        {"brand": F.col("tweet_id").cast("string"), "username": F.lit("u"), "sentiment": F.lit("Neutral"),
         **{c: F.lit(0.0) for c in ("polarity", "subjectivity", "confidence")}})
    history.insert_unseen(rows, str(tmp_path / "h"), "tweet_id")
    assert len(dealt) == 1 and "tweet_id" in dealt[0] and not {"tweet", "clean_tweet"} & set(dealt[0])
    found = history.read_history(spark, str(tmp_path / "h")).orderBy("timestamp").collect()
    assert [(r["brand"], r["tweet"]) for r in found] == [("0", "same"), ("2", "same")]


def test_digests_of_all_sinks_are_shuffled_as_bytes(spark, tmp_path, monkeypatch):
    """The digest of each sink's texts is that of `md5`, a null text's is null."""
    from murmur.plans import catalog
    rows = spark.createDataFrame([(START, t, "B", "u", "Neutral", 0.5, 0.5, 0.5) for t in ("one", "one", None)],
                                 "timestamp TIMESTAMP, tweet STRING, brand STRING, username STRING, sentiment STRING, "
                                 "polarity DOUBLE, subjectivity DOUBLE, confidence DOUBLE")
    sinks.write_batch(rows, f"{tmp_path}/mentions", 0)
    sinks.write_batch(rows.select(*sinks.csv_columns(rows)), f"{tmp_path}/csv", 0, "csv", **sinks.CSV)
    history.insert_unseen(rows.withColumn("tweet_id", F.lit(1)), f"{tmp_path}/history", "tweet_id")
    monkeypatch.setattr(catalog, "finished_sinks", lambda *_: str(tmp_path))
    made = catalog.st4_one_query_all_sinks(spark, "")
    groups = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "count(1)" in line]
    assert groups and all("md5" not in line for line in groups)
    assert dict(made.dtypes)["digest"] == "string" and "unhex(md5" in made._jdf.queryExecution().optimizedPlan().toString()
    found = {(r["sink"], r["digest"]): r["n"] for r in made.collect()}
    one = "f97c5d29941bfb1b2fdab0874906ab82"
    assert found == {(s, d): 2 if s != "history" and d else 1 for s in ("mentions", "csv", "history") for d in (one, None)}


def test_shares_of_a_live_batch_shuffle_their_rows_alone(spark, tmp_path, monkeypatch):
    """Rows meet their texts once; a share is one shuffle, by envelope, of rows kept in order of their texts."""
    plans, kept = [], []

    def spied(*args, old=sinks.envelopes):
        made = old(*args)
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        kept.append([r["tweet"] for r in args[0].select("tweet").collect()])
        return made
    monkeypatch.setattr(sinks, "LIVE_ROWS", 100)
    monkeypatch.setattr(sinks, "envelopes", spied)
    rows = spark.range(400).select(F.col("id").alias("tweet_id"), F.timestamp_seconds("id").alias("timestamp"),
                                   F.concat(F.lit("text "), (F.col("id") % 3).cast("string")).alias("tweet"))
    sinks.write_live(rows.coalesce(1), str(tmp_path), 0, 10)
    assert len(plans) == 5 and all(p.count("Exchange") == 1 for p in plans)
    changes = sum(a != b for texts in kept for a, b in zip(texts, texts[1:]))
    assert sum(map(len, kept)) == 400 and changes < 100  # in order of time every row would have another text than the one before


def test_sinks_without_shuffles_come_last(spark, tmp_path, monkeypatch):
    order = []
    for name in ("write_live", "insert_unseen", "write_batch"):
        monkeypatch.setattr(sinks, name, lambda *a, name=name, old=getattr(sinks, name), **k: order.append(name) or old(*a, **k))
    dated = jobs.dated_mentions(ingest.parse_json_payload(stream_of(spark, messages(spark), str(tmp_path / "in"))))
    sinks.all_sinks(dated, default_lexicon(spark), str(tmp_path / "out"), **ONCE).awaitTermination()
    assert order == ["write_batch", "write_live", "insert_unseen", "write_batch"]
