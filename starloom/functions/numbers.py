"""Number casts and decimal fitting."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def to_int(text: Column) -> Column:
    return text.try_cast("int")


def to_long(text: Column) -> Column:
    return text.try_cast("bigint")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_decimal(text: Column, precision: int = 15, scale: int = 5) -> Column:
    return text.try_cast(f"decimal({precision},{scale})")


def fit_decimal(value: Column, scale: int, mode: str = "round", precision: int = 18) -> Column:
    """Fit a number to a scale, rounding half away from zero or cutting digits off.

    Cutting compares decimals, not doubles, so 246.9 at scale 0 is 246 and 0.29 at scale 2 stays
    0.29: the rounded value is taken one step back where it went away from zero.
    """
    kind = f"decimal({precision},{scale})"
    if mode == "round":
        return value.try_cast(kind)
    if mode != "truncate":
        raise ValueError(f"mode must be 'round' or 'truncate', not {mode!r}")
    nearest = value.try_cast(f"decimal({min(precision + 1, 38)},{scale})")
    exact = value.try_cast(f"decimal({min(precision + 10, 38)},{scale + 10})")
    step = F.lit(Decimal(1).scaleb(-scale))
    cut = (
        F.when((exact > 0) & (nearest > exact), nearest - step)
        .when((exact < 0) & (nearest < exact), nearest + step)
        .otherwise(nearest)
    )
    return cut.try_cast(kind)


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)
