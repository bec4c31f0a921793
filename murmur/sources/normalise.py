"""Column aliases, defaults and label-only rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur import settings as S
from murmur.functions.display import parse_timestamp
from murmur.operators.spans import dense_rank

# The columns a field may come from, first non-empty one wins.
ALIASES = {
    "timestamp": ("timestamp", "produced_at"),
    "tweet": ("tweet", "tweet_text", "text"),
    "brand": ("brand", "entity"),
    "username": ("username", "user"),
    "sentiment": ("sentiment", "sentiment_label"),
}
DEFAULTS = {"brand": S.DEFAULT_BRAND, "username": S.DEFAULT_USER, "sentiment": S.DEFAULT_LABEL}
NUMBERS = ("polarity", "subjectivity", "confidence")


def _first_filled(df: DataFrame, field: str) -> Column:
    present = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ALIASES[field] if c in df.columns]
    return F.coalesce(*present, F.lit(DEFAULTS.get(field)).cast("string"))


def title_case(text: Column) -> Column:
    """Every letter that follows no letter in upper case, the others in lower."""
    letter = r"\p{L}"
    runs = F.split(F.lower(text), rf"(?<={letter})(?!{letter})|(?<!{letter})(?={letter})")
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substr(r, F.lit(2)))), "")


def number_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def normalise(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Mentions from any frame with some of the known columns; rows without text go.

    The timestamp becomes an instant in UTC; text that is no timestamp becomes null.
    """
    numbers = [(number_or_zero(F.col(c)) if c in df.columns else F.lit(0.0)).alias(c) for c in NUMBERS]
    return df.select(
        *keep, parse_timestamp(_first_filled(df, "timestamp")).alias("timestamp"),
        _first_filled(df, "tweet").alias("tweet"), _first_filled(df, "brand").alias("brand"),
        _first_filled(df, "username").alias("username"),
        title_case(_first_filled(df, "sentiment")).alias("sentiment"), *numbers,
    ).filter(F.col("tweet").isNotNull())


def impute_from_label(df: DataFrame, order: str, as_of: Column) -> DataFrame:
    """Scores and timestamps for rows that carry only a label, one minute apart, the last at `as_of`.

    `order` is a whole-number column without repeats, such as tweet_id.
    """
    label = title_case(_first_filled(df, "sentiment"))
    label = F.when(label.isin(list(S.LABELS)), label).otherwise(S.DEFAULT_LABEL)
    polarity = F.create_map(*[F.lit(x) for item in S.LABEL_POLARITY.items() for x in item])
    rows = dense_rank(df.withColumn("_label", label), order, "_rank")
    behind = (F.lit(df.count()) - F.col("_rank")).cast("int")
    return rows.select(
        order, (as_of - F.make_dt_interval(mins=behind)).alias("timestamp"),
        _first_filled(df, "tweet").alias("tweet"), _first_filled(df, "brand").alias("brand"),
        F.lit(S.DEFAULT_USER).alias("username"), F.col("_label").alias("sentiment"),
        polarity[F.col("_label")].alias("polarity"), F.lit(S.LABEL_SUBJECTIVITY).alias("subjectivity"),
        F.lit(S.LABEL_CONFIDENCE).alias("confidence"))
