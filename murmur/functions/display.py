"""Values as reports, feeds and exports show them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur import settings as S

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, ISO_UTC)


def parse_timestamp(text: Column) -> Column:
    """ISO date or date-time text as an instant; no offset means UTC, anything else null.

    A time without a date is no instant: it would be read as of today.
    """
    return F.when(text.rlike(r"^\s*[+-]?\d{4}"), F.try_to_timestamp(text))


def spreadsheet_safe(text: Column) -> Column:
    """Quote text a spreadsheet would run as a formula."""
    return F.when(text.rlike(r"^[ \t\r\n]*[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)


def decimal_text(number: Column) -> Column:
    """A double in plain decimals, never with an exponent, as long as that is still the same double."""
    text = number.cast("string")

    def same(places: int) -> Column:
        digits = text.try_cast(f"decimal(38,{places})").cast("string")
        digits = F.regexp_replace(digits, r"0+$", "") if places else F.concat(digits, F.lit("."))
        shown = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
        return F.when(shown.try_cast("double") == number, shown)
    return F.when(text.contains("E"), F.coalesce(same(37), same(18), same(0), text)).otherwise(text)


def tweet_hash(timestamp: Column, tweet: Column) -> Column:
    """The identity of a mention; a missing timestamp or text counts as empty."""
    return F.sha2(F.concat(F.coalesce(timestamp, F.lit("")), F.lit("|"), F.coalesce(tweet, F.lit(""))), 256)


def html_escape(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def report_snippet(text: Column, chars: int = S.REPORT_CHARS) -> Column:
    return F.replace(html_escape(F.substring(text, 1, chars)), F.lit("\n"), F.lit(" "))


def relative_age(ts: Column, as_of: Column) -> Column:
    minutes = F.greatest(F.lit(0), F.timestamp_diff("MINUTE", ts, as_of))
    return (F.when(ts.isNull(), "recently").when(minutes < 1, "now")
            .when(minutes < 60, F.concat(minutes.cast("string"), F.lit("m ago")))
            .otherwise(F.concat(F.floor(minutes / 60).cast("string"), F.lit("h ago"))))
