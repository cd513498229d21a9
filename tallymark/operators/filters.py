"""Row filters."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymark.functions.dates import to_day

Day = str | datetime.date


def period_condition(moment: Column, start: Day, end: Day, *, as_text: bool = False) -> Column:
    """``start <= moment <= end``, both ends included; a NULL moment never matches.

    Compared by calendar day, so the whole end day is inside even for timestamps; ``as_text`` compares strings letter
    by letter instead. An inverted period matches nothing. A bound that is not a date raises when compared by day.
    """
    if as_text:
        return moment.between(F.lit(start), F.lit(end))
    return to_day(moment).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def in_period(
    df: DataFrame, column: str, start: Day, end: Day, *, as_text: bool | None = None, strict: bool = False
) -> DataFrame:
    """Rows of the period. A STRING column is compared as text unless ``as_text=False`` asks for dates.

    A text that is no date then matches no period, as a NULL does (:func:`tallymark.operators.quality.date_conformity`
    counts such rows); with ``strict`` it raises.
    """
    is_text = isinstance(df.schema[column].dataType, StringType)
    if as_text is None:
        as_text = is_text
    moment = F.col(column)
    if is_text and not as_text and not strict:
        moment = moment.try_cast("date")
    return df.filter(period_condition(moment, start, end, as_text=as_text))


def on_day(df: DataFrame, column: str, day: Day, *, as_text: bool | None = None) -> DataFrame:
    """Rows of a single day."""
    return in_period(df, column, day, day, as_text=as_text)


def with_value(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not NULL."""
    return df.filter(F.col(column).isNotNull())


def before_first_null(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows that come before the first NULL ``value`` when read in ascending order of ``key``.

    This is what a loop that stops at the first NULL copies. It takes one small aggregate and a filter, not a window
    over all rows. NULL keys come first in the order; if one of them has a NULL value, nothing is copied.
    """
    stop = df.agg(
        F.struct(
            F.min(F.when(F.col(value).isNull(), F.col(key))).alias("at_key"),
            F.coalesce(F.bool_or(F.col(value).isNull() & F.col(key).isNull()), F.lit(False)).alias("at_start"),
        ).alias("stop")
    ).scalar()
    at_key = stop.getField("at_key")
    return df.filter(~stop.getField("at_start") & (F.col(key).isNull() | at_key.isNull() | (F.col(key) < at_key)))
