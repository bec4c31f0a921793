"""The training-corpus pipeline: quality, shared lines, near duplicates, benchmark leaks, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it to the shared
folder and the next stage reads that table, so a lost executor costs one stage's work at most.
All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import decontaminate, fertility, lines, simhash
from murmur.llm.common import fresh, settled
from murmur.llm.queries import bpe_digests, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the fertility fences keep."""
    m, fence, kept = fresh(docs, "_measures"), fresh(docs, "_fence"), fresh(docs, "_kept")
    measured = settled(docs.withColumn(m, fertility.measure(spark, F.col("text"))), "measures")
    judged = fertility.fenced(measured, m, fence).withColumn(kept, fertility.judge(F.col(m), F.col(fence))["kept"])
    return judged.where(F.col(kept)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier document holds; n_chars counts what is left."""
    kept = lines.drop_repeated_lines(docs)
    return kept.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
                         for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return bpe_digests(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: Pieces of a vocabulary and byte-pair merges are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
