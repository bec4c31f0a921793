"""Labels, confidence, buckets and colours as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.fixed import mean_of_micro, round_binary
from murmur.functions.text import bind


def label(polarity: Column, positive: float = S.POSITIVE_THRESHOLD,
          negative: float = S.NEGATIVE_THRESHOLD) -> Column:
    return (F.when(polarity >= positive, "Positive")
            .when(polarity <= negative, "Negative").otherwise("Neutral"))


def confidence(polarity: Column, subjectivity: Column) -> Column:
    boosted = F.abs(polarity) + S.SUBJECTIVITY_WEIGHT * subjectivity
    return F.least(F.lit(1.0), round_binary(boosted, 4))


def score_struct(total_polarity: Column, total_subjectivity: Column, hits: Column) -> Column:
    """Scores from lexicon sums in millionths; text without a hit scores zero, Neutral."""
    means = F.struct(
        F.coalesce(mean_of_micro(total_polarity, hits, 4), F.lit(0.0)).alias("p"),
        F.coalesce(mean_of_micro(total_subjectivity, hits, 4), F.lit(0.0)).alias("s"))
    return bind(means, lambda m: F.struct(
        m["p"].alias("polarity"), m["s"].alias("subjectivity"),
        label(m["p"]).alias("sentiment"), confidence(m["p"], m["s"]).alias("confidence")))


def score_0_100(mean_polarity: Column) -> Column:
    return F.round((mean_polarity + 1) / 2 * 100, 1)


def _bucket_case(polarity: Column, names) -> Column:
    """The value of `names` (lowest bucket first) for a polarity; null stays null."""
    lowest, negative, neutral, positive, highest = map(F.lit, names)
    return (F.when(polarity <= -S.STRONG_POLARITY, lowest)
            .when(polarity <= S.NEGATIVE_THRESHOLD, negative)
            .when(polarity < S.POSITIVE_THRESHOLD, neutral)
            .when(polarity < S.STRONG_POLARITY, positive)
            .when(polarity >= S.STRONG_POLARITY, highest))


def polarity_bucket(polarity: Column) -> Column:
    return _bucket_case(polarity, S.BUCKETS)


def bucket_order(polarity: Column) -> Column:
    return _bucket_case(polarity, range(1, 6))


def label_colour(sentiment: Column) -> Column:
    start = F.when(F.lit(False), F.lit(""))
    cases = reduce(lambda c, kv: c.when(sentiment == kv[0], kv[1]), S.LABEL_COLOURS.items(), start)
    return cases.otherwise(S.OTHER_COLOUR)


def polarity_colour(polarity: Column) -> Column:
    return F.when(polarity >= 0, S.UP_COLOUR).otherwise(S.DOWN_COLOUR)
