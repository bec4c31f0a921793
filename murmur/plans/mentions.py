"""The mention view over the driver tables.

Every event is a mention of one document: its type is the brand, its user the
author. A document is scored once, however many events point to it, and its text
is joined in only where a result shows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions.text import clean_tokens
from murmur.operators.scoring import score_by_join
from murmur.session import spread

#: Rows of the largest page a user can ask for.
PAGE_ROWS = 100
SCORES = ("polarity", "subjectivity", "sentiment", "confidence")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test lexicon: the words of `benchmark` with weights drawn from a digest of the word."""
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(clean_tokens(F.col("text"))).alias("word")).distinct()
    drawn = F.conv(F.substring(F.md5(F.col("word")), 1, 4), 16, 10).cast("int")
    return words.select("word", ((drawn % 201 - 100) / 100).alias("polarity"),
                        (drawn % 101 / 100).alias("subjectivity"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("tweet"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_by_join(spread(docs), lexicon(spark, sf_dir), "doc_id", "tweet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions without score or text, each with the document it points to."""
    n_docs = table(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("mention_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("brand"), F.col("user_id").cast("string").alias("username"),
        (F.col("event_id") % n_docs).alias("doc_id"))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored mentions, without their text."""
    return events(spark, sf_dir).join(scored_documents(spark, sf_dir), "doc_id")


def with_document(rows: DataFrame, sf_dir: str, **columns: Column) -> DataFrame:
    """`rows` with columns computed from the text of their document, once per document."""
    docs = spread(documents(rows.sparkSession, sf_dir))
    return rows.join(docs.select("doc_id", *[c.alias(n) for n, c in columns.items()]), "doc_id")


def with_tweet(rows: DataFrame, sf_dir: str) -> DataFrame:
    return with_document(rows, sf_dir, tweet=F.col("tweet"))


def few_with_tweet(rows: DataFrame, sf_dir: str, **columns: Column) -> DataFrame:
    """The same for the rows of one page, at most PAGE_ROWS.

    The page is fetched first; its document ids go to the reader as a filter, so only the row
    groups that hold them are read.
    """
    spark = rows.sparkSession
    page = rows.limit(PAGE_ROWS + 1).collect()
    if len(page) > PAGE_ROWS:
        raise ValueError(f"a page has at most {PAGE_ROWS} rows: use with_document")
    docs = documents(spark, sf_dir).filter(F.col("doc_id").isin(sorted({r["doc_id"] for r in page})))
    wanted = columns or {"tweet": F.col("tweet")}
    return docs.join(F.broadcast(spark.createDataFrame(page, rows.schema)), "doc_id").select(
        *rows.columns, *[c.alias(n) for n, c in wanted.items()])
