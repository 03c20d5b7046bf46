"""Dates arrive as text; nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_day_month_year(c: Column) -> Column:
    """"23 Feb 2025" to a date; unreadable text gives null."""
    return F.try_to_date(F.trim(c), "d MMM yyyy")


def parse_iso(c: Column) -> Column:
    return F.try_to_date(c.cast("string"), "yyyy-MM-dd")


def date_key(c: Column) -> Column:
    """yyyyMMdd as text, the key format of fact tables."""
    return F.date_format(c, "yyyyMMdd")


def date_key_int(c: Column) -> Column:
    return date_key(c).cast("int")


def month_before(as_of: Column) -> Column:
    return F.add_months(as_of, -1)


def calendar_features(c: Column) -> dict[str, Column]:
    return {
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "week": F.weekofyear(c),
        "quarter": F.quarter(c),
        "dayofyear": F.dayofyear(c),
    }
