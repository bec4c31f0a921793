"""Substring search over stored texts by an index of trigrams.

Texts lie in a fixed number of blocks, a folder each, by a hash of their key. The index
tells for each trigram in which blocks it occurs. A search reads the postings of its
needle's trigrams, then the blocks that have all of them, and looks there into the texts:
the rows are those of a full scan, and what is read falls with the needle's rarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.functions.text import bind
from murmur.operators.filters import holds

BLOCKS = 256
GRAM = 3


def trigrams(text: Column) -> Column:
    """Hashes of the distinct trigrams of a text in lower case; none of a text under three characters."""
    def grams(chars: Column) -> Column:
        places = F.when(F.size(chars) >= GRAM, F.sequence(F.lit(0), F.size(chars) - GRAM)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(places, lambda i: F.xxhash64(*[F.get(chars, i + k) for k in range(GRAM)])))
    # An empty text has one empty part, and a part that is empty ends the list in some cases.
    return bind(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), ""), ""), grams)


def build_index(texts: DataFrame, path: str, key: str, text: str, blocks: int = BLOCKS) -> None:
    """Write `texts` by block and the postings (gram, block), ordered by trigram, under `path`."""
    placed = texts.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    placed.hint("rebalance", "block").write.partitionBy("block").parquet(f"{path}/texts")
    stored = texts.sparkSession.read.parquet(f"{path}/texts")
    postings = stored.select("block", F.explode(trigrams(F.col(text))).alias("gram")).distinct()
    postings.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, needle: str) -> DataFrame:
    """The blocks (block) that have all trigrams of the needle; all blocks for a needle under three characters."""
    postings = spark.read.parquet(f"{path}/postings")
    wanted = spark.range(1).select(F.explode(trigrams(F.lit(needle))).alias("gram")).collect()  # as many as the needle has characters
    if not wanted:
        return spark.read.parquet(f"{path}/texts").select("block").distinct()
    hits = postings.filter(F.col("gram").isin([r["gram"] for r in wanted]))
    return hits.groupBy("block").agg(F.count("*").alias("n")).filter(F.col("n") == len(wanted)).select("block")


def search(spark: SparkSession, path: str, needle: str, text: str) -> DataFrame:
    """The stored rows whose text holds the needle, whatever its case; Spark reads the candidate blocks alone."""
    blocks = candidates(spark, path, needle).withColumnRenamed("block", "_block")
    texts = spark.read.parquet(f"{path}/texts")
    # A row for each block at most, of a fixed number of blocks.
    found = texts.join(F.broadcast(blocks), F.col("block") == F.col("_block"), "left_semi")
    return found.filter(holds(F.col(text), needle)).drop("block")
