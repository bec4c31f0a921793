"""Lines that several documents share: kept in the first document only, told as bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import BLANKS, bind, fresh, lower_ascii

#: Code points of the shortest line key that counts.
MIN_KEY = 10
#: A bitmap word stands for 2 ** WORD_BITS lines.
WORD_BITS = 6


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _variant(text: Column) -> Column:
    """31 bits of the text: tells rows apart that share a doc_id and not the text."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(0x7FFFFFFF))


def repeated_lines(documents: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """Lines to drop as (doc_id, place): lines whose key an earlier document holds.

    `place` is the text's variant in the high and the line number in the low 32 bits.
    Keys are 128 bits of hash. Lines are range-partitioned by key and block of documents
    and sorted by document and place; the first document of a run keeps its lines, later
    ones lose theirs. Blocks are dealt by a hash of the id, as many as there are partitions:
    a line that a third of all documents hold is spread over many tasks, however the ids
    lie, and a second pass over the runs' first documents alone, one for each block at
    most, finds the first of all.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id"), _variant(F.col("text")).alias("_variant"),
        F.posexplode(F.transform(text_lines(F.col("text")), line_key)).alias("_at", "_key"))
    hashed = lines.where(F.length("_key") >= min_key).select(
        F.xxhash64("_key").alias("h1"), F.xxhash64(F.lit("line"), "_key").alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("block"), "doc_id",
        F.shiftleft("_variant", 32).bitwiseOR(F.col("_at").cast("long")).alias("place"))
    order = ["h1", "h2", "block", "doc_id", "place"]
    ranged = hashed.repartitionByRange(parts, "h1", "h2", "block").sortWithinPartitions(*order)
    run = Window.partitionBy("h1", "h2", "block").orderBy("doc_id", "place").rowsBetween(Window.unboundedPreceding, 0)
    streamed = ranged.withColumn("first", F.first("doc_id").over(run))
    later = streamed.where("doc_id != first").select("doc_id", "place")
    heads = streamed.where("doc_id = first").select("h1", "h2", "doc_id", "place")
    key = Window.partitionBy("h1", "h2").orderBy("doc_id", "place").rowsBetween(Window.unboundedPreceding, 0)
    late_heads = heads.withColumn("first", F.first("doc_id").over(key)).where("doc_id != first").select("doc_id", "place")
    return later.unionAll(late_heads)


def _bit(line: Column) -> Column:
    return line.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")


def keep_bitmaps(documents: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """(doc_id, variant, dropped) for each document that loses lines.

    `dropped` is a sparse bitmap, sorted (word, bits): bit b of word w stands for line
    64 w + b. Absent words and documents keep all lines, so documents without a shared
    line cost nothing.
    """
    place = F.col("place")
    at = place.bitwiseAND(F.lit(0xFFFFFFFF))
    words = (repeated_lines(documents, min_key)
             .groupBy("doc_id", F.shiftright(place, 32).alias("variant"),
                      F.shiftright(at, WORD_BITS).cast("int").alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(at))).alias("bits")))
    return words.groupBy("doc_id", "variant").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def _dense(dropped: Column, n_lines: Column) -> Column:
    """The sparse bitmap as one word for each 64 lines."""
    by_word = F.map_from_entries(dropped)
    return bind(by_word, lambda m: F.transform(
        F.sequence(F.lit(0), F.shiftright(n_lines - 1, WORD_BITS)),
        lambda w: F.coalesce(F.try_element_at(m, w), F.lit(0).cast("long"))))


def _kept_lines(lines: Column, dropped: Column) -> Column:
    def with_bits(x: Column) -> Column:
        return F.filter(x["lines"], lambda line, i: F.call_function(
            "shiftright", F.get(x["bits"], F.shiftright(i, WORD_BITS)), _bit(i)).bitwiseAND(F.lit(1).cast("long")) == 0)
    return bind(F.struct(lines.alias("lines"), dropped.alias("dropped")), lambda x: bind(
        F.struct(x["lines"].alias("lines"), _dense(x["dropped"], F.size(x["lines"])).alias("bits")), with_bits))


def drop_repeated_lines(documents: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """`documents` with shared lines cut from `text`, and new columns n_lines and n_dropped.

    A key of fewer than `min_key` code points is never dropped. Null or empty text is one
    empty line. Rows that share a doc_id are one document: they don't count as two. A row
    without doc_id neither counts nor loses lines. Repeated rows give equal rows. The two
    new columns get other names if `documents` has such ones.
    """
    bitmaps = keep_bitmaps(documents, min_key)
    v, d = fresh(documents, "_variant"), fresh(documents, "_dropped")
    i = fresh(documents, "_id")
    marked = documents.withColumn(v, _variant(F.col("text"))).join(
        bitmaps.select(F.col("doc_id").alias(i), F.col("variant").alias(f"{v}b"), F.col("dropped").alias(d)),
        (F.col("doc_id") == F.col(i)) & (F.col(v) == F.col(f"{v}b")), "left")
    lines = text_lines(F.col("text"))
    n_dropped = F.coalesce(F.aggregate(F.col(d), F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"])), F.lit(0))
    text = F.when(F.col(d).isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(_kept_lines(lines, F.col(d)), "\n"))
    return marked.select(*[text.alias(c) if c == "text" else F.col(c) for c in documents.columns],
                         F.size(lines).cast("long").alias(fresh(documents, "n_lines")),
                         n_dropped.cast("long").alias(fresh(documents, "n_dropped")))
