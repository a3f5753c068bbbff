"""Text rules: names compare without case and without trailing blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_key(text: Column) -> Column:
    """The form in which two names are compared."""
    return F.lower(F.rtrim(text))


def contains_text(text: Column, piece: str) -> Column:
    return F.contains(F.lower(text), F.lit(piece.lower()))


def has_text(text: Column) -> Column:
    """True when the text holds more than blanks; NULL for NULL."""
    return F.rtrim(text) != ""


def zip5(zipcode: Column) -> Column:
    return F.substring(zipcode, 1, 5)
