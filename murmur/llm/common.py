"""Column helpers that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANKS = " \t\n\x0b\x0c\r"
#: Rows and bytes of one Arrow batch at most, so that texts and what is made of them do not fill a task's memory.
ARROW_ROWS, ARROW_BYTES = 512, 4 << 20


def prepare(spark: SparkSession) -> None:
    """Bound what Python workers receive at once, in rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or a variant of it that no column of `df` has in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, although `use` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def ascii_words(text: Column) -> Column:
    """The lower-cased words of a text: runs of a-z, 0-9 and non-ASCII characters; of null none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that tell rows apart by id and text; equal rows share them."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(doc_id.cast("string"), whole).alias("k1"),
            F.xxhash64(F.lit("murmur"), whole, doc_id.cast("string")).alias("k2")]


def gram_text(words: Column, pos: Column, length: int | Column) -> Column:
    """The words from `pos` on, space-joined."""
    return F.array_join(F.slice(words, pos + 1, length), " ")


def word_windows(df: DataFrame, keys: list[str], words: str, lengths: list[int]) -> DataFrame:
    """Every run of `length` words by a rolling hash: keys, words, pos, length, h.

    `pos` counts from the text's first word. The arrays of a text stand beside each of its
    windows as references within one generated loop; only what is selected from the result
    after a filter or broadcast join is written out, so no window is.
    """
    hashed = df.select(*keys, words, F.transform(words, lambda w: F.xxhash64(w)).alias("_h"))
    # The outer form, as the plain one would first make the arrays once more to see if they are empty.
    at = hashed.select(*keys, words, "_h", F.posexplode_outer("_h").alias("pos", "_first"))

    def key(length: int) -> Column:
        rest = [F.get("_h", F.col("pos") + k) for k in range(1, length)]
        return F.when(F.col("pos") + length <= F.size("_h"), F.xxhash64(F.lit(length), "_first", *rest))
    if len(lengths) == 1:
        rows = at.select(*keys, words, "pos", F.lit(lengths[0]).alias("length"), key(lengths[0]).alias("h"))
    else:
        rows = at.select(*keys, words, "pos", F.explode(F.array(*[
            F.struct(F.lit(n).alias("length"), key(n).alias("h")) for n in lengths])).alias("_w")).select(
            *keys, words, "pos", "_w.length", "_w.h")
    return rows.where(F.col("h").isNotNull())


def window_hash(words: Column, lengths: list[int]) -> Column:
    """The hash `word_windows` gives a run that is the whole array `words`, of one of the lengths."""
    return F.coalesce(*[F.when(F.size(words) == n, F.xxhash64(
        F.lit(n), *[F.xxhash64(F.get(words, F.lit(k))) for k in range(n)])) for n in lengths])


def same_text(a: Column, b: Column) -> Column:
    """a = b in a form that stays a condition of a join and does not become one of its hashed keys."""
    return (a >= b) & (a <= b)


_held: list = []


def held(make: Callable, path: str):
    """`make(path)`, kept by a Python worker until it needs another one: a worker holds one vocabulary and its memo."""
    if not _held or _held[0] != (make, path):
        _held[:] = [(make, path), None]  # the old one goes before the new one comes
        _held[1] = make(path)
    return _held[1]


def settled(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends there, a lost executor loses nothing."""
    return settle(df, name)


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with its scheme: one without is where Spark would write it, not on the disk of whoever opens it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def store_of(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's file system and place for a qualified path."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def batch_name() -> str:
    return uuid.uuid4().hex
