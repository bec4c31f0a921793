"""Benchmark passages inside training documents: found by a broadcast set of word windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import ascii_words, bind, fresh, gram_text, row_key, same_text, settled, window_hash, word_windows

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Bytes of benchmark windows that may be broadcast; beyond it the windows' hashes are shuffled.
BROADCAST_BYTES = 64 << 20


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Windows (length, gram, c1, c2) of each distinct item text, and its item ids (c1, c2, item_ids).

    Copies of one item are one class, so their windows are made once.
    """
    words = benchmark.select("item_id", ascii_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    joined = F.array_join("words", " ")
    # A class's ids are one cell, as the answer for a document that holds it is one cell of these ids.
    classes = (words.groupBy(F.xxhash64(joined).alias("c1"), F.xxhash64(F.lit("item"), joined).alias("c2"))
               .agg(F.first("words").alias("words"), F.collect_set(F.col("item_id").cast("string")).alias("item_ids")))
    lengths = F.least(F.size("words"), F.lit(window)).alias("length")
    of_class = bind(F.col("words"), lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - F.least(F.size(w), F.lit(window))),
        lambda i: F.array_join(F.slice(w, i + 1, F.least(F.size(w), F.lit(window))), " ")))
    windows = classes.select("c1", "c2", lengths, F.explode(of_class).alias("gram")).distinct()
    return windows, classes.select("c1", "c2", "item_ids")


def find_leaks(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hits: k1, k2 (see `row_key`), pos, length, gram, for every document window that is a benchmark window.

    Window texts are compared by hash in the join and then word for word. The set of
    benchmark windows is broadcast if its measured bytes allow. Else only places and hashes
    of windows are shuffled, and the words of those texts alone that have a window of a
    benchmark hash; the rows are the same.
    """
    windows, _ = item_windows(benchmark, window)
    grams = windows.select("length", "gram").distinct()
    known = grams.groupBy("length").agg(F.sum(F.octet_length("gram") + 40).alias("bytes")).collect()
    lengths = sorted(r["length"] for r in known) or [window]
    keyed = documents.select(*row_key(F.col("doc_id"), F.col("text")), ascii_words(F.col("text")).alias("words"))
    scanned = word_windows(keyed, ["k1", "k2"], "words", lengths)
    targets = grams.select(F.col("gram").alias("target"), window_hash(F.split("gram", " "), lengths).alias("code"))
    gram = gram_text(F.col("words"), F.col("pos"), F.col("length"))
    if sum(r["bytes"] for r in known) <= broadcast_bytes:
        found = (F.col("h") == F.col("code")) & same_text(gram, F.col("target"))
        return scanned.join(F.broadcast(targets), found).select("k1", "k2", "pos", "length", F.col("target").alias("gram"))
    targets = settled(targets, "targets")
    likely = settled(scanned.select("k1", "k2", "pos", "length", "h").join(targets, F.col("h") == F.col("code"))
                     .select("k1", "k2", "pos", "length", "target"), "likely")
    texts = settled(keyed.join(likely.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]), "texts")
    return likely.join(texts, ["k1", "k2"]).where(gram == F.col("target")).select(
        "k1", "k2", "pos", "length", F.col("target").alias("gram")).distinct()


def covered(spans: Column) -> Column:
    """Places in the union of an array of (pos, length) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(done: Column, s: Column) -> Column:
        end = F.greatest(done["end"], s["pos"] + s["length"])
        return F.struct((done["n"] + end - F.greatest(done["end"], s["pos"])).alias("n"), end.alias("end"))
    return F.aggregate(F.array_sort(spans), start, step, lambda done: done["n"])


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_hit, spans, item_ids, contaminated.

    `spans` are the merged hit places as (pos, length) in words, `item_ids` the items
    with occurring windows, sorted as strings. A null or empty text has no words and no
    hit; an item without words has no window; a null item_id marks words but is no name
    in the list. Repeated rows give equal rows each, a null doc_id is kept, other columns
    are not read. An empty benchmark leaves every document clean.
    """
    hits = settled(find_leaks(documents, benchmark, window, broadcast_bytes), "hits")
    windows, classes = item_windows(benchmark, window)
    spans = hits.groupBy("k1", "k2").agg(F.collect_set(F.struct("pos", "length")).alias("spans"))
    named = (hits.select("k1", "k2", "gram").distinct().join(windows.select("gram", "c1", "c2"), "gram")
             .select("k1", "k2", "c1", "c2").distinct().join(classes, ["c1", "c2"])
             .groupBy("k1", "k2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids")))
    rows = documents.select("doc_id", *row_key(F.col("doc_id"), F.col("text")),
                            F.size(ascii_words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (rows.join(spans.join(named, ["k1", "k2"], "left"), ["k1", "k2"], "left")
            .select("doc_id", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0)).alias("n_hit"),
                    F.array_sort("spans").alias("spans"), F.coalesce("item_ids", none).alias("item_ids"),
                    F.col("spans").isNotNull().alias("contaminated")))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents without a benchmark window, all columns as they were."""
    hit = find_leaks(documents, benchmark, window, broadcast_bytes).select("k1", "k2").distinct()
    a, b = fresh(documents, "_k1"), fresh(documents, "_k2")
    one, two = row_key(F.col("doc_id"), F.col("text"))
    keyed = documents.withColumns({a: one, b: two})
    hit = hit.withColumnsRenamed({"k1": a, "k2": b})
    return keyed.join(hit, [a, b], "left_anti").select(*documents.columns)


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id and the lower-cased words of each document outside every benchmark window, space-joined."""
    spans = find_leaks(documents, benchmark, window, broadcast_bytes).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("pos", "length")).alias("spans"))
    rows = documents.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), ascii_words(F.col("text")).alias("words"))

    def kept(pair: Column) -> Column:
        return F.array_join(F.filter(pair["words"], lambda w, i: ~F.exists(
            pair["spans"], lambda s: (s["pos"] <= i) & (i < s["pos"] + s["length"]))), " ")
    return rows.join(spans, ["k1", "k2"], "left").select("doc_id", F.when(
        F.col("spans").isNull(), F.array_join("words", " ")).otherwise(
        bind(F.struct("words", "spans"), kept)).alias("text"))
