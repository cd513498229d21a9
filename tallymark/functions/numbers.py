"""Numbers: casts that do not fail and sums that do not depend on the order of the rows."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_number(value: Column, to: str = "double") -> Column:
    """``value`` as a number, NULL where it is not one (the plain cast raises in ANSI mode)."""
    return value.try_cast(to)


def exact_sum(value: Column, scale: int = 2) -> Column:
    """Sum of ``value`` through decimals of ``scale`` digits, as a double: the same for every order of the rows.

    No value is cut: one with more digits than ``scale`` or beyond 38 digits raises. What a double cannot tell from a
    number of ``scale`` digits (a relative distance of 1e-13, of 2e-7 for FLOAT) counts as one. NaN and Infinity make the
    sum what a plain sum makes of it. Values up to 15 digits are summed as longs.
    """
    return exact_total(exact_parts(value, scale), scale)


def exact_parts(value: Column, scale: int = 2) -> dict[str, Column]:
    """Aggregates that make up an :func:`exact_sum`. Each may be summed over the parts of a group to that of the whole.

    ``low`` and ``high`` are the digits of values up to 15 digits, split so that the longs of 10^11 rows do not overflow
    (an overflow would raise), ``large`` the sum of larger values, ``odd`` of NaN and Infinity.
    """
    number = value.cast("double")
    finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
    small = F.abs(number) < F.lit(10.0 ** (15 - scale))
    digits = F.when(finite & small, kept_long(value, scale))
    return {
        "low": F.sum(digits.bitwiseAND(F.lit(_LOW))),
        "high": F.sum(F.shiftright(digits, _LOW_BITS)),
        "large": F.sum(F.when(finite & ~small, kept_decimal(value, scale, 38))),
        "odd": F.sum(F.when(~finite, number)),
    }


_LOW_BITS = 24
_LOW = (1 << _LOW_BITS) - 1


def exact_total(parts: Mapping[str, Column], scale: int = 2) -> Column:
    """The total that :func:`exact_parts` make up, as a double; NULL if there was no value."""
    digits = parts["high"].cast("decimal(20,0)") * F.lit(Decimal(_LOW + 1)) + parts["low"].cast("decimal(20,0)")
    plain = F.concat(digits.cast("string"), F.lit(f"E-{scale}")).cast("double")  # rounded once
    large = parts["large"].cast("double")
    return F.coalesce(parts["odd"], plain + large, plain, large)


def kept_long(value: Column, scale: int) -> Column:
    """``value``, below 10^(15 - ``scale``), times 10^``scale`` as a long; raises where digits would be lost."""
    number = value.cast("double")
    scaled = number * F.lit(10.0**scale)
    whole = F.rint(scaled)
    slack = F.when(F.typeof(value) == "float", 2e-7).otherwise(1e-13)
    lost = F.raise_error(F.concat(F.lit(f"value is not kept by {scale} digits: "), value.cast("string")))
    exact = (value.cast(f"decimal(18,{scale})") * F.lit(Decimal(10**scale))).cast("long")
    kept = F.when(F.typeof(value).isin("double", "float"), whole.cast("long")).otherwise(exact)
    return F.when(F.abs(whole - scaled) <= slack * F.abs(scaled), kept).otherwise(lost.cast("long"))


def kept_decimal(value: Column, scale: int, precision: int = 18) -> Column:
    """``value`` as a decimal; raises where that would change it (NaN and Infinity included), as in :func:`exact_sum`."""
    kind = f"decimal({precision},{scale})"
    number = value.cast("double")
    scaled = number * F.lit(10.0**scale)
    slack = F.when(F.typeof(value) == "float", 2e-7).otherwise(1e-13)
    # NaN is larger than every number, so it does not fit either
    same = (F.abs(number) < F.lit(10.0 ** (precision - scale))) & (F.abs(F.rint(scaled) - scaled) <= slack * F.abs(scaled))
    lost = F.raise_error(F.concat(F.lit("value is not kept by "), F.lit(kind), F.lit(": "), value.cast("string")))
    return F.when(F.coalesce(same, value.isNull()), value.cast(kind)).otherwise(lost.cast(kind))
