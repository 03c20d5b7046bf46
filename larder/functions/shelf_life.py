"""Shelf-life text such as "3-4 Days" or "1+ Years" to a number of days."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from larder.functions.text import once

# Days per unit; any other unit counts as 1.
DAYS_PER_UNIT = {
    "day": 1, "days": 1,
    "week": 7, "weeks": 7,
    "month": 30, "months": 30,
    "year": 365, "years": 365,
}
# Fixed value: the duration grammar.
DURATION = r"(\d+\*?\s*(?:-\s*\d+)?\s*(?:\+)?\s*(?i:Years?|Months?|Days?|Weeks?|Hours?)?)"


def duration_days(c: Column, compat: bool = False) -> Column:
    """Lower bound of the first duration found, in days; null when there is none.

    Hours are rounded up to whole days. ``compat=True`` counts an hour as a day,
    as the original rule did.
    """
    found = F.regexp_extract(c, DURATION, 1)
    found = F.regexp_replace(found, r" - ", "-")
    words = F.split(F.trim(F.regexp_replace(found, r"[*+]", "")), " ")
    number_and_unit = once(words, lambda w: F.struct(
        F.get(F.split(F.get(w, F.lit(0)), "-"), F.lit(0)).try_cast("int").alias("number"), F.lower(F.get(w, F.lit(1))).alias("unit")))

    def in_days(read: Column) -> Column:
        number, unit = read["number"], read["unit"]
        days = F.when(unit.isin("hour", "hours") & F.lit(not compat), F.ceil(number / 24))
        for word, factor in DAYS_PER_UNIT.items():
            days = days.when(unit == word, number * factor)
        return days.otherwise(number).cast("int")

    return once(number_and_unit, in_days)
