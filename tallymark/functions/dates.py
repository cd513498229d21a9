"""Dates and time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"


def is_iso_date(text: Column) -> Column:
    """True for a real calendar date written as ``yyyy-MM-dd``; false for anything else, NULL and '' included.

    Months and days need two digits: ``2023-1-1`` is false, although a plain cast would accept it.
    """
    return F.try_to_date(text, ISO_DATE).isNotNull()


def to_day(moment: Column) -> Column:
    """The calendar day of a date or timestamp. Catalyst turns a range test on it into a pushed timestamp range."""
    return moment.cast("date")


def shift_zone(moment: Column, from_zone: str, to_zone: str = "UTC") -> Column:
    """Wall-clock time of ``from_zone`` as wall-clock time of ``to_zone``, daylight saving included.

    Both sides are zone-less timestamps, so the session's own time zone has no influence.
    """
    return F.convert_timezone(F.lit(from_zone), F.lit(to_zone), moment)
