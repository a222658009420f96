"""Keys, defaults and text forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def missing_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def default_if_missing(text: Column, default: str) -> Column:
    """The default for null and for empty text alike."""
    return F.coalesce(missing_if_blank(text), F.lit(default))


def email_key(email: Column) -> Column:
    """Join key of a person; blank is no key at all."""
    return missing_if_blank(F.lower(F.trim(email)))


def country_key(text: Column) -> Column:
    """Letters and digits in capitals, so that spellings of one country fold together."""
    return missing_if_blank(F.regexp_replace(F.upper(F.trim(text)), "[^A-Z0-9]", ""))


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def exact_text(amount: Column) -> Column:
    """A decimal as text, every digit kept."""
    return amount.cast("string")


def utc_instant(text: Column) -> Column:
    """Text with an offset (or Z) as the UTC instant without zone; null when it does not parse."""
    return text.try_cast("timestamp").cast("timestamp_ntz")
