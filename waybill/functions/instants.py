"""Timestamps as text: RFC 3339 check and the canonical UTC form, exact to the nanosecond.

Everything works on text and on zone-less timestamps, so results do not depend on the session time zone and
no digit of the fraction is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE_TIME = (
    r"^\d{4}-\d{2}-\d{2}[Tt](?:(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d|23:59:60)"
    r"(?:\.\d+)?(?:[Zz]|[+-](?:[01]\d|2[0-3]):[0-5]\d)$"
)


def is_date_time(text: Column) -> Column:
    """True for an RFC 3339 date-time with an existing calendar day."""
    return text.rlike(DATE_TIME) & F.substring(text, 1, 10).try_cast("date").isNotNull()


def _fraction(text: Column) -> Column:
    return F.regexp_extract(text, r"\.(\d+)", 1)


def _offset_minutes(text: Column) -> Column:
    """Minutes east of UTC, given a checked date-time that does not end in Z."""
    tail = F.right(text, F.lit(6))
    minutes = F.substring(tail, 2, 2).try_cast("int") * 60 + F.substring(tail, 5, 2).try_cast("int")
    return F.when(F.substring(tail, 1, 1) == "-", -minutes).otherwise(minutes)


def is_instant(text: Column) -> Column:
    """Whether a checked date-time is also an instant: at most 9 fraction digits, offset within 18 hours."""
    zulu = text.endswith("Z") | text.endswith("z")
    return (F.length(_fraction(text)) <= 9) & (zulu | (F.abs(_offset_minutes(text)) <= 18 * 60))


def utc_text(text: Column) -> Column:
    """Canonical UTC text of a checked instant: seconds always shown, fraction absent or 3, 6 or 9 digits, 'Z'."""
    seconds = F.upper(F.substring(text, 1, 19))
    seconds = F.when(seconds.endswith(":60"), F.concat(F.substring(seconds, 1, 17), F.lit("59"))).otherwise(seconds)
    shifted = F.replace(
        F.timestamp_add("MINUTE", -_offset_minutes(text), seconds.try_cast("timestamp_ntz")).cast("string"),
        F.lit(" "), F.lit("T"),
    )
    whole = F.when(text.endswith("Z") | text.endswith("z"), seconds).otherwise(shifted)
    # Without its trailing zeros and with two put at the end, the fraction begins with the groups of three to keep.
    digits = F.rtrim(F.regexp_extract(text, r"\.\d+", 0), F.lit("0"))
    fraction = F.regexp_extract(F.concat(digits, F.lit("00")), r"^(?:\.(?:\d{3})+)?", 0)
    return F.concat(whole, fraction, F.lit("Z"))


def canonical_instant(text: Column) -> Column:
    """Canonical UTC text of any text; NULL if it is not an instant."""
    return F.when(is_date_time(text) & is_instant(text), utc_text(text))
