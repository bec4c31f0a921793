"""Text cleaning as native column expressions (no UDF)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce
from importlib import resources

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the cleaning removes. Character classes are spelt out so that
# they mean the same in every regex dialect.
URL = r"(?:https?://|www\.)[^\t-\r\x1c-\x20\x85\p{Z}]+"
MENTION = r"@[\p{L}\p{N}_]+"
NON_ASCII = r"[^\x00-\x7F]+"
MENTION_OR_NON_ASCII = MENTION + "|" + NON_ASCII
PUNCTUATION = r"[!-/:-@\[-`{-~]+"
SPACES = r"[\t-\r\x1c-\x20]+"

# Words the tokeniser splits in two even without an apostrophe.
SPLIT_WORDS = {"cannot": "can not", "gimme": "gim me", "gonna": "gon na",
               "gotta": "got ta", "lemme": "lem me", "wanna": "wan na"}


@lru_cache(maxsize=1)
def stopwords() -> tuple[str, ...]:
    """The shipped English stop words."""
    text = resources.files("murmur.data").joinpath("stopwords_en.txt").read_text()
    lines = (line for line in text.splitlines() if not line.startswith("#"))
    return tuple(word for line in lines for word in line.split())


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def text_id(text: Column) -> Column:
    """The digest by which rows name a text that is kept apart from them; null for null."""
    return F.unhex(F.sha2(text, 256))


def lowercase(text: Column) -> Column:
    return F.lower(text)


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def remove_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, " ")


def remove_hashtag_symbols(text: Column) -> Column:
    return F.replace(text, F.lit("#"), F.lit(""))


def remove_emojis(text: Column) -> Column:
    """Every run of non-ASCII characters, emoji included, becomes one space."""
    return F.regexp_replace(text, NON_ASCII, " ")


def remove_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, "")


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _contains_any(text: Column, needles) -> Column:
    found = [F.contains(text, F.lit(needle)) for needle in needles]
    return reduce(lambda a, b: a | b, found)


def _split_parts(token: Column) -> Column:
    parts = F.create_map(*[F.lit(x) for item in SPLIT_WORDS.items() for x in item])
    return F.when(token.isin(list(SPLIT_WORDS)), F.split(parts[token], " ")).otherwise(F.array(token))


def tokenize(text: Column) -> Column:
    """Tokens of text that has lost its punctuation; blank text has none."""
    tokens = F.array_remove(F.split(text, SPACES), "")
    return bind(tokens, lambda ts: F.when(
        F.arrays_overlap(ts, F.array(*map(F.lit, SPLIT_WORDS))),
        F.flatten(F.transform(ts, _split_parts))).otherwise(ts))


def remove_stopwords(tokens: Column, words: tuple[str, ...] | None = None) -> Column:
    drop = list(words if words is not None else stopwords())
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(drop))


def strip_markup(text: Column) -> Column:
    """Lower-cased text without URLs, mentions, non-ASCII and punctuation.

    A regex pass costs some hundred times a byte search, so each pass runs only
    on rows that hold what it removes. Mentions and non-ASCII runs cannot overlap
    and both become a space, so one pass takes them; '#' goes with punctuation.
    """
    text = bind(lowercase(text_or_empty(text)), lambda t: F.when(
        _contains_any(t, ("http", "www.")), remove_urls(t)).otherwise(t))
    text = bind(text, lambda t: F.when(
        (F.octet_length(t) == F.length(t)) & ~F.contains(t, F.lit("@")), t).otherwise(
        F.regexp_replace(t, MENTION_OR_NON_ASCII, " ")))
    return remove_punctuation(text)


def normalise(text: Column) -> Column:
    """All steps before tokenising, as one line of text."""
    return collapse_whitespace(strip_markup(text))


def all_tokens(text: Column) -> Column:
    return tokenize(strip_markup(text))


def clean_tokens(text: Column) -> Column:
    return remove_stopwords(all_tokens(text))


def clean_tweet(text: Column) -> Column:
    return F.array_join(clean_tokens(text), " ")
