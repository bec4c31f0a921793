"""Lexicon scoring: (word, polarity, subjectivity) rows against the tokens of a text."""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions.fixed import to_micro
from murmur.functions.sentiment import score_struct
from murmur.functions.text import all_tokens, clean_tweet, stopwords, text_id

LEXICON = "word STRING, polarity DOUBLE, subjectivity DOUBLE"

def default_lexicon(spark: SparkSession) -> DataFrame:
    """The shipped starter lexicon. Real use passes its own table."""
    text = resources.files("murmur.data").joinpath("lexicon_en.csv").read_text()
    lines = [line.split(",") for line in text.splitlines() if line and not line.startswith("#")]
    rows = [(word, float(polarity), float(subjectivity)) for word, polarity, subjectivity in lines[1:]]
    return spark.createDataFrame(rows, LEXICON)


def token_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per token that survives the stop words."""
    rows = df.select(key, F.explode(all_tokens(F.col(text))).alias("word"))
    return rows.filter((F.length("word") > 1) & ~F.col("word").isin(list(stopwords())))


def score_by_join(df: DataFrame, lexicon: DataFrame, key: str, text: str) -> DataFrame:
    """One row per `key` with its scores, for a lexicon of any size; `key` has no repeats.

    A plain join: Spark broadcasts a lexicon whose size it knows to be small and shuffles
    the words otherwise, splitting frequent ones. Only words that hit go on, and a
    partial sum per key goes before the shuffle; keys without a hit come back from `df`.
    """
    words = lexicon.select("word", to_micro(F.col("polarity")).alias("p"),
                           to_micro(F.col("subjectivity")).alias("s"))
    sums = token_rows(df, key, text).join(words, "word").groupBy(F.col(key).alias("_key")).agg(
        F.sum("p").alias("p"), F.sum("s").alias("s"), F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    scored = df.select(key).join(sums, F.col(key) == F.col("_key"), "left").select(
        key, score_struct(F.coalesce("p", zero), F.coalesce("s", zero), F.coalesce("n", zero)).alias("_score"))
    return scored.select(key, "_score.*")


def score_batch(rows: DataFrame, lexicon: DataFrame, text: str = "tweet") -> DataFrame:
    """`rows` with clean_tweet and the four score columns.

    For tables and for the batches of a stream, whatever the size of the lexicon. A task keeps
    one copy of each of its texts before they are shuffled; a text is cleaned and scored once
    and meets the rows, which name it by a digest. The rows of a text come out together, so
    that packed files hold little more than one copy of it.
    """
    keyed = rows.withColumns({"_text": text_id(F.coalesce(text, F.lit(""))), "_null": F.col(text).isNull()})
    texts = keyed.groupBy("_text").agg(F.first(F.coalesce(text, F.lit(""))).alias("_value"))
    words = lexicon.select("word", to_micro(F.col("polarity")).alias("p"), to_micro(F.col("subjectivity")).alias("s"))
    sums = token_rows(texts, "_text", "_value").join(words, "word").groupBy("_text").agg(
        F.sum("p").alias("p"), F.sum("s").alias("s"), F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    scored = texts.join(sums, "_text", "left").select(
        "_text", "_value", clean_tweet(F.col("_value")).alias("clean_tweet"),
        score_struct(*[F.coalesce(c, zero) for c in "psn"]).alias("_score"))
    found = keyed.drop(text).join(scored, "_text").withColumn(text, F.when(~F.col("_null"), F.col("_value")))
    return found.select(*rows.columns, "clean_tweet", "_score.*")
