"""Cleaning and scoring against the published sample and hand cases."""

import pytest
from pyspark.sql import functions as F

from murmur.functions import sentiment, text
from murmur.operators.scoring import default_lexicon, score_batch, score_by_join

# The published sample: (text, cleaned text, polarity, subjectivity, label, confidence).
SAMPLE = [
    ('I am coming to the borders and I will kill you all',
     'coming borders kill', 0.0, 0.0, 'Neutral', 0.0),
    ('im getting on borderlands and i will kill you all',
     'im getting borderlands kill', 0.0, 0.0, 'Neutral', 0.0),
    ('im coming on borderlands and i will murder you all',
     'im coming borderlands murder', 0.0, 0.0, 'Neutral', 0.0),
    ('So bad. This game is absolutely terrible and full of bugs',
     'bad game absolutely terrible full bugs', -0.4375, 0.6542, 'Negative', 0.5356),
    ('Worst update ever, the servers keep crashing every five minutes',
     'worst update ever servers keep crashing every five minutes', -1.0, 1.0, 'Negative', 1.0),
    ('Just got my order early, amazing service as always! Thank you Amazon',
     'got order early amazing service always thank amazon', 0.35, 0.6, 'Positive', 0.44),
    ('Package arrived today, it is a medium sized box with the item inside',
     'package arrived today medium sized box item inside', 0.0, 0.0, 'Neutral', 0.0),
    ('Google Pixel camera is honestly incredible, best phone camera I have used',
     'google pixel camera honestly incredible best phone camera used', 0.95, 0.6, 'Positive', 1.0),
    ('Windows update broke my laptop again, so frustrated right now',
     'windows update broke laptop frustrated right', -0.2071, 0.3679, 'Negative', 0.2623),
    ('Installed the new Office update, seems fine so far',
     'installed new office update seems fine far', 0.2177, 0.6515, 'Positive', 0.3154),
    ('Tesla autopilot saved me today, absolutely love this car',
     'tesla autopilot saved today absolutely love car', 0.5, 0.6, 'Positive', 0.59),
    ('Tesla service center took 3 weeks to fix a simple issue, unacceptable',
     'tesla service center took weeks fix simple issue unacceptable', -0.05, 0.2286, 'Negative', 0.0843),
    ('New season of my favorite show just dropped on Netflix, so excited!',
     'new season favorite show dropped netflix excited', 0.3371, 0.7348, 'Positive', 0.4473),
    ('Netflix keeps cancelling good shows, so disappointed with their decisions',
     'netflix keeps cancelling good shows disappointed decisions', -0.025, 0.675, 'Neutral', 0.1263),
    ('Spotify wrapped is coming up soon I think',
     'spotify wrapped coming soon think', 0.0, 0.0, 'Neutral', 0.0),
    ("Spotify's new playlist recommendations are spot on, love the algorithm",
     'spotifys new playlist recommendations spot love algorithm', 0.3182, 0.5273, 'Positive', 0.3973),
    ('Facebook ads are so annoying now, every third post is an ad',
     'facebook ads annoying every third post ad', -0.4, 0.45, 'Negative', 0.4675),
    ('Logged into Facebook after a long time, a lot has changed',
     'logged facebook long time lot changed', -0.05, 0.4, 'Negative', 0.11),
    ('PS5 exclusive games are absolutely stunning, best graphics I have seen',
     'ps5 exclusive games absolutely stunning best graphics seen', 0.75, 0.65, 'Positive', 0.8475),
    ('PSN servers down again, cannot play online with friends, so annoying',
     'psn servers play online friends annoying', -0.8, 0.9, 'Negative', 0.935),
    ('Xbox Game Pass is honestly the best value in gaming right now',
     'xbox game pass honestly best value gaming right', 0.2952, 0.4119, 'Positive', 0.357),
    ('Xbox controller battery lasts about 20 hours for me',
     'xbox controller battery lasts 20 hours', 0.0, 0.0, 'Neutral', 0.0),
    ('New iPhone camera is a huge upgrade, photos look incredible',
     'new iphone camera huge upgrade photos look incredible', 0.4788, 0.7515, 'Positive', 0.5915),
    ('iPhone battery life has gotten so much worse after the update',
     'iphone battery life gotten much worse update', -0.4, 0.6, 'Negative', 0.49),
    ('Verizon customer service put me on hold for over an hour, ridiculous',
     'verizon customer service put hold hour ridiculous', -0.3333, 1.0, 'Negative', 0.4833),
    ('Amazon delivery was three days late and the box was damaged',
     'amazon delivery three days late box damaged', -0.3, 0.6, 'Negative', 0.39),
    ('Using Google Maps to find a new restaurant nearby',
     'using google maps find new restaurant nearby', 0.1364, 0.4545, 'Positive', 0.2046),
    ('New CallOfDuty map design is fantastic, really well balanced',
     'new callofduty map design fantastic really well balanced', 0.2455, 0.5182, 'Positive', 0.3232),
    ('Saw a new Tesla model on the road today',
     'saw new tesla model road today', 0.1364, 0.4545, 'Positive', 0.2046),
    ('Binge watched the entire series in one weekend, absolutely hooked',
     'binge watched entire series one weekend absolutely hooked', 0.1, 0.7625, 'Positive', 0.2144),
]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, "tweet STRING, clean STRING, p DOUBLE, s DOUBLE, label STRING, c DOUBLE")


def test_published_sample(sample):
    rows = sample.select("tweet", "clean", text.clean_tweet(F.col("tweet")).alias("got"), "label", "c",
                         sentiment.label(F.col("p")).alias("got_label"),
                         sentiment.confidence(F.col("p"), F.col("s")).alias("got_c")).collect()
    for r in rows:
        assert (r["got"], r["got_label"], r["got_c"]) == (r["clean"], r["label"], r["c"]), r["tweet"]


@pytest.mark.parametrize("raw, clean", [
    (None, ""), ("", ""), ("   ", ""),
    ("OMG!! LOVE the new #iPhone \U0001F60D\U0001F60D https://x.com/a?b=1 @Apple", "omg love new iphone"),
    ("see www.site.org/x now", "see"), ("a/b it's", "ab"), ("café crème", "caf cr"),
    ("I'm gonna gimme wanna cannot", "im gon na gim wan na"), ("tab\tline\nbreak\x1fend", "tab line break end"),
    ("mail me@home.org", "mail org"), ("@@x #@y", ""), (" padded ", "padded"),
])
def test_cleaning(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t STRING")
    assert df.select(text.clean_tweet(F.col("t"))).first()[0] == clean


@pytest.mark.parametrize("polarity, label", [
    (0.05, "Positive"), (0.0499, "Neutral"), (-0.05, "Negative"), (-0.0499, "Neutral"), (0.0, "Neutral")])
def test_label_edges(spark, polarity, label):
    assert spark.range(1).select(sentiment.label(F.lit(polarity))).first()[0] == label


def test_buckets_and_colours(spark):
    df = spark.createDataFrame([(-0.5,), (-0.05,), (0.0,), (0.05,), (0.5,), (None,)], "p DOUBLE")
    got = [(r[0], r[1]) for r in df.select(sentiment.polarity_bucket(F.col("p")), sentiment.bucket_order(F.col("p"))).collect()]
    assert got == [("Strongly Negative", 1), ("Negative", 2), ("Neutral", 3), ("Positive", 4),
                   ("Strongly Positive", 5), (None, None)]
    colours = spark.createDataFrame([("Positive",), ("Irrelevant",), (None,)], "s STRING")
    assert [r[0] for r in colours.select(sentiment.label_colour(F.col("s"))).collect()] == ["#27AE60", "#BDC3C7", "#BDC3C7"]


def test_both_scorers_agree(spark, sample):
    lexicon = default_lexicon(spark)
    texts = sample.select(F.monotonically_increasing_id().alias("id"), "tweet").unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, "  ")], "id BIGINT, tweet STRING"))
    columns = ["id", "polarity", "subjectivity", "sentiment", "confidence"]
    one = score_batch(texts, lexicon).select(*columns)
    two = score_by_join(texts, lexicon, "id", "tweet").select(*columns)
    assert sorted(one.collect()) == sorted(two.collect())
    blank = {tuple(r)[1:] for r in one.filter("id < 0").collect()}
    assert blank == {(0.0, 0.0, "Neutral", 0.0)}


def test_default_lexicon_on_the_sample(spark, sample):
    rows = score_batch(sample, default_lexicon(spark)).collect()
    assert len(rows) == 30 and sum(r["polarity"] == r["p"] for r in rows) >= 5


def test_large_lexicon_is_shuffled(spark, sample):
    texts = sample.select(F.monotonically_increasing_id().alias("id"), "tweet")
    lexicon = default_lexicon(spark)
    expected = sorted(score_by_join(texts, lexicon, "id", "tweet").collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = score_by_join(texts, lexicon, "id", "tweet")
        assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(large.collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_building_a_scored_query_starts_no_job(spark):
    from murmur.plans import catalog
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        for name in ("n1_lexicon_score", "j6_lexicon_join", "a14_word_frequency", "t4_j5_meta_lookup"):
            frame = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
            # Reading a file's schema is a job of Spark's reader; the plan itself runs none.
            assert not any("Exchange" in s for s in frame._jdf.queryExecution().logical().toString().splitlines())
        stages = [tracker.getJobInfo(j).stageIds for j in tracker.getJobIdsForGroup("build")]
        assert all(len(s) == 1 for s in stages)
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_time_alone_is_no_instant(spark):
    from murmur.functions.display import parse_timestamp
    texts = ["12:30:45", "T08:00", "2024-01-05T10:20:30", " 2024-01-05", "", None, "soon"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(parse_timestamp(F.col("t")).isNotNull()).collect()
    assert [r[0] for r in rows] == [False, False, True, True, False, False, False]


def test_title_case_is_by_letters(spark):
    from murmur.sources.normalise import title_case
    texts = ["very-negative x", "POSITIVE", "a1b o'neil", "élan vital", "", " x  y"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(title_case(F.col("t"))).collect()
    assert [r[0] for r in rows] == [t.title() for t in texts]


def test_meta_lookup_trims_all_white_space(spark):
    from murmur.operators.replay import with_meta
    source = spark.createDataFrame([(1, "hello\n", "Acme\t", " me")], "id INT, tweet_text STRING, brand STRING, username STRING")
    found = with_meta(spark.createDataFrame([(9, "\thello")], "tweet_id INT, tweet_text STRING"), source, "id").first()
    assert (found["brand"], found["username"]) == ("Acme", "me")


def test_entries_of_one_time_fold_alike(spark):
    from datetime import datetime
    from murmur.operators.alerts import fold_alert_log, latest_status, upsert_alerts
    at = datetime(2026, 1, 1)
    log = [("a", t, "d", "High", s, at) for t, s in (("one", "Open"), ("two", "Acknowledged"), ("three", "Open"))]
    schema = "alert_id STRING, title STRING, detail STRING, severity STRING, status STRING, at TIMESTAMP"
    states = set()
    for rows in (log, log[::-1], log[1:] + log[:1]):
        frame = spark.createDataFrame(rows, schema).repartition(3)
        states.add(tuple(fold_alert_log(frame).first()))
        states.add(tuple(upsert_alerts(fold_alert_log(frame.filter("false")), frame).first()))
    assert states == {("a", "two", "d", "High", "Acknowledged", at, at)}
    moves = spark.createDataFrame([("a", "resolve", at), ("a", "acknowledge", at)], "alert_id STRING, action STRING, at TIMESTAMP")
    assert latest_status(moves).first()["status"] == "Resolved"


def test_confidence_rounds_the_binary_value(spark):
    df = spark.range(10001).select((F.col("id") / 10000).alias("s")).crossJoin(
        spark.createDataFrame([(0.0,), (0.025,), (-0.1234,), (0.4375,)], "p DOUBLE"))
    rows = df.select("p", "s", sentiment.confidence(F.col("p"), F.col("s")).alias("c")).collect()
    assert all(r["c"] == min(1.0, round(abs(r["p"]) + 0.15 * r["s"], 4)) for r in rows)
