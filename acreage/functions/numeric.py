"""Numeric expressions that never raise on raw data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = 1e-9


def number(c: Column) -> Column:
    """The value as a double; null where it is no finite number."""
    x = F.trim(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def positive_float(c: Column) -> tuple[Column, Column, Column]:
    """(value or null, valid, raw number)"""
    raw = number(c)
    valid = F.coalesce(raw > 0, F.lit(False))
    return F.when(valid, raw), valid, raw


def is_whole(raw: Column) -> Column:
    return F.abs(raw - F.rint(raw)) <= WHOLE


def positive_integer(c: Column) -> tuple[Column, Column, Column, Column]:
    """(value or null, valid, raw number, positive but not whole)"""
    raw = number(c)
    positive = F.coalesce(raw > 0, F.lit(False))
    whole = F.coalesce(is_whole(raw), F.lit(False))
    return F.when(positive & whole, F.rint(raw).try_cast("bigint")), positive & whole, raw, positive & ~whole


def nonnegative_integer(c: Column) -> tuple[Column, Column, Column]:
    """(value or null, valid, failed: not blank and not valid)"""
    raw = number(c)
    valid = F.coalesce((raw >= 0) & is_whole(raw), F.lit(False))
    return F.when(valid, F.rint(raw).try_cast("int")), valid, F.coalesce(F.trim(c.cast("string")) != "", F.lit(False)) & ~valid


def close(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) <= tolerance


def sum_present(columns: Sequence[Column]) -> Column:
    """Sum of what is there; null if nothing is."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0))
    return F.when(F.coalesce(*columns).isNotNull(), total)


def bucket(c: Column, bounds: Sequence[int], unit: str = "") -> Column:
    """Labels like 1-3, 4-6, >6 for whole numbers from 1 on; null below."""
    out, low = F.when(c > bounds[-1], f">{bounds[-1]}{unit}"), 1
    for high in bounds:
        out = out.when((c >= low) & (c <= high), f"{low}-{high}{unit}")
        low = high + 1
    return out
