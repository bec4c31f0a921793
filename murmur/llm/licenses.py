"""Licence notices in texts: base phrases, and templates found by votes along diagonals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.llm.common import ascii_words, bind, gram_text, row_key, same_text, window_hash, word_windows

# Phrases that must be found as they stand, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Label, words and key words of sentences of public licences and of the notices that name them, in lower case.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at", "apache"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", ""),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu public"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the "
     "gnu general public license as published by the free software foundation", "gnu"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
     "fee is hereby granted", ""),
    ("mit-notice", "released under the mit license", "mit"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction", ""),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
]

#: Words of a gram for templates of LONG words or more, and for shorter ones, of which only grams with a key word count.
GRAM, SHORT_GRAM, LONG = 4, 2, 12
#: Diagonals at most this far apart are one span: words put in or left out.
NEIGHBOUR = 3
#: Share of a template's words that a span must hold, and its length against the template's.
MIN_SHARE, MAX_STRETCH = 0.75, 1.5


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, label, t, keys, gram, t_pos, target): each gram of each template; a few rows by the list's length.

    `t` are its words and `keys` the places of its key words, which tell it from others.
    """
    rows = []
    for n, (label, text, keys) in enumerate(templates):
        words = text.split()
        gram = GRAM if len(words) >= LONG else SHORT_GRAM
        if len(words) < gram or gram == SHORT_GRAM and not keys:
            raise ValueError(f"a template needs {gram} words, and a short one key words: {text!r}")
        own = [i for i, w in enumerate(words) if w in keys.split()]
        rows += [(n, label, words, own, gram, i, " ".join(words[i:i + gram])) for i in range(len(words) - gram + 1)
                 if gram == GRAM or set(own) & set(range(i, i + gram))]
    return spark.createDataFrame(rows, "template int, label string, t array<string>, keys array<int>, gram int, t_pos int, target string")


def base_places(words: Column, phrases=PHRASES) -> Column:
    """Array of (start, label) of every place where a phrase's words stand."""
    def at(w: Column, i: Column, phrase: str) -> Column:
        test = None
        for k, word in enumerate(phrase.split()):
            same = F.get(w, i + k) == word
            test = same if test is None else test & same
        return F.coalesce(test, F.lit(False))

    def label(w: Column, i: Column) -> Column:
        cases = [F.when(at(w, i, phrase), name) for phrase, name in phrases]
        return F.coalesce(*cases)

    heads = sorted({phrase.split()[0] for phrase, _ in phrases})
    return bind(words, lambda w: F.filter(F.transform(w, lambda word, i: F.when(
        word.isin(heads), F.struct(i.alias("start"), label(w, i).alias("label")))), lambda x: x["label"].isNotNull()))


def _found(words: Column, t: Column, diagonal: Column, neighbour: int) -> Column:
    """Places in the template whose word stands in the text on the diagonal or one at most `neighbour` away."""
    return F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda j: F.exists(
        F.sequence(F.lit(-neighbour), F.lit(neighbour)), lambda e: F.coalesce(F.get(words, j + diagonal + e) == F.get(t, j), F.lit(False))))


def licence_spans(documents: DataFrame, templates=TEMPLATES, neighbour: int = NEIGHBOUR,
                  min_share: float = MIN_SHARE, max_stretch: float = MAX_STRETCH) -> DataFrame:
    """Verified spans: k1, k2 (see `row_key`), template, label, start, end, n, share.

    Every k-gram of every text meets the template places by hash and then word for word;
    hits vote for their diagonal (place in text less place in template); diagonals at most
    `neighbour` apart whose hits follow each other in the text are one span. A span is
    verified word for word: `n` words of its template stand in the text on its diagonals or
    near them. It holds if these are enough of the template, all key words among them, and
    it isn't stretched too far. Of spans that overlap the one with most words stays, of
    equals the one with the larger share, then the earlier template.
    """
    grams = template_grams(documents.sparkSession, templates)
    lengths = sorted({GRAM, SHORT_GRAM})
    grams = grams.withColumn("code", window_hash(F.split("target", " "), lengths))
    keyed = documents.select(*row_key(F.col("doc_id"), F.col("text")), ascii_words(F.col("text")).alias("words"))
    scanned = word_windows(keyed, ["k1", "k2"], "words", lengths)
    same = same_text(gram_text(F.col("words"), F.col("pos"), F.col("gram")), F.col("target"))
    diagonal = F.col("pos") - F.col("t_pos")
    hits = scanned.join(F.broadcast(grams), (F.col("h") == F.col("code")) & same).select(
        "k1", "k2", "template", "label", F.size("t").alias("t_words"), "keys", "gram", "pos", diagonal.alias("diagonal"),
        _found(F.col("words"), F.col("t"), diagonal, neighbour).alias("found"))
    of = ["k1", "k2", "template"]
    told = [F.first(c).alias(c) for c in ("label", "t_words", "keys", "gram")]
    diagonals = hits.groupBy(*of, "diagonal").agg(
        F.min("pos").alias("start"), F.max("pos").alias("last"), F.first("found").alias("found"), *told)
    by = Window.partitionBy(*of).orderBy("diagonal")
    # Spans of one text that are neighbours by diagonal but apart in the text are two finds.
    near = F.col("gram") + neighbour
    joins = ((F.col("diagonal") - F.lag("diagonal").over(by) <= neighbour)
             & (F.col("start") <= F.lag("last").over(by) + near) & (F.col("last") >= F.lag("start").over(by) - near))
    merged = (diagonals.withColumn("new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1))
              .withColumn("span", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*of, "span").agg(F.min("start").alias("start"), (F.max("last") + F.first("gram")).alias("end"),
                                        F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"), *told[:3]))
    n = F.size("found")
    holds = ((n >= min_share * F.col("t_words")) & (F.size(F.array_except("keys", "found")) == 0)
             & (F.col("end") - F.col("start") <= F.col("t_words") * max_stretch + neighbour))
    spans = merged.where(holds).select("k1", "k2", F.struct(
        n.alias("n"), (n.cast("double") / F.col("t_words")).alias("share"), (-F.col("template")).alias("rank"), "label", "start", "end").alias("s"))
    # Spans that overlap, directly or by others, are an island; only within one some give way.
    text = Window.partitionBy("k1", "k2").orderBy("s.start", "s.end", "s.rank")
    reached = F.max("s.end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    islands = (spans.withColumn("new", F.when(F.col("s.start") < reached, 0).otherwise(1))
               .withColumn("island", F.sum("new").over(text.rowsBetween(Window.unboundedPreceding, 0)))
               .groupBy("k1", "k2", "island").agg(F.collect_list("s").alias("all")))

    def stays(s: Column, every: Column) -> Column:
        def rank(x: Column) -> Column:
            return F.struct(x["n"], x["share"], x["rank"])
        return ~F.exists(every, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]) & (rank(o) > rank(s)))
    kept = islands.select("k1", "k2", F.explode(bind(F.col("all"), lambda every: F.filter(every, lambda s: stays(s, every)))).alias("s"))
    return kept.select("k1", "k2", (-F.col("s.rank")).alias("template"), "s.label", "s.start", "s.end", "s.n", "s.share")


def scan_licences(documents: DataFrame, **how) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Labels are distinct, sorted and comma-joined; `labels` adds those of template spans to
    the base ones; `score` is the best span's share of its template, 0 without a span. A null
    or empty text has no words, no labels and null first_word and last_word. Repeated rows
    give equal rows each, a null doc_id is kept, other columns are not read.
    """
    spans = licence_spans(documents, **how).groupBy("k1", "k2").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("score"))
    words = documents.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), ascii_words(F.col("text")).alias("w"))
    base = words.select("doc_id", "k1", "k2", bind(F.col("w"), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), base_places(w).alias("places"))).alias("b"))
    starts = F.transform("b.places", lambda p: p["start"].cast("long"))
    names = F.transform("b.places", lambda p: p["label"])
    none = F.array().cast("array<string>")
    return base.join(spans, ["k1", "k2"], "left").select(
        "doc_id", "b.n_words", F.size("b.places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(names, F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
