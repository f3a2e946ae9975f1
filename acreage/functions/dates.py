"""Calendar expressions. ROC years count from 1911."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acreage.functions.numeric import number

ROC = 1911


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "MM")


def build_date(year: Column, month: Column, day: Column) -> Column:
    """The date, null if there is no such day; never raises."""
    whole = lambda c: F.when(number(c) == F.rint(number(c)), F.rint(number(c)).try_cast("int"))
    return F.try_to_date(F.format_string("%04d-%02d-%02d", whole(year), whole(month), whole(day)), "yyyy-MM-dd")


def roc_period(year: Column, month: Column) -> Column:
    return number(year) * 100 + number(month)


def valid_period(year: Column, month: Column, start: int, end: int) -> Column:
    return F.coalesce(
        number(year).isNotNull() & number(month).between(1, 12) & roc_period(year, month).between(start, end), F.lit(False)
    )


def split_compact(c: Column) -> tuple[Column, Column, Column]:
    """(year, month, day) of a 6 or 7 digit ROC date, nulls for others."""
    s = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    s = F.when(s.rlike(r"^\d{6,7}$"), s)
    return tuple(x.try_cast("int") for x in (F.substring(s, 1, F.length(s) - 4), F.substring(s, -4, 2), F.substring(s, -2, 2)))


def completion(c: Column, not_applicable: Column) -> tuple[Column, Column]:
    """(date, status): missing, ambiguous_5_digit, valid, invalid or not_applicable."""
    raw = number(c)
    whole = F.coalesce(raw == F.rint(raw), F.lit(False))
    digits = F.when(whole, F.abs(raw).try_cast("bigint").cast("string"))
    year, month, day = split_compact(digits)
    date = F.when(raw > 0, F.try_to_date(F.format_string("%04d-%02d-%02d", year + ROC, month, day), "yyyy-MM-dd"))
    blank = c.isNull() | (F.trim(c.cast("string")) == "")
    status = F.when(not_applicable, "not_applicable").when(blank, "missing").when(
        F.length(digits) == 5, "ambiguous_5_digit"
    ).when(date.isNotNull(), "valid").otherwise("invalid")
    return F.when(~F.coalesce(not_applicable, F.lit(False)), date), status


def month_gap(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def month_range(start: Column, stop: Column) -> Column:
    """Month starts from start to stop; none where start is after stop."""
    return F.when(start <= stop, F.sequence(start, stop, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))
