"""Text clean-up, search and casing."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def squeeze(c: Column) -> Column:
    """Trim and collapse runs of whitespace to one space."""
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def strip_hidden(c: Column) -> Column:
    """Drop non-printing characters (controls, format marks, all separators but the blank), then trim."""
    return F.trim(F.regexp_replace(c, r"[\p{C}\p{Z}&&[^ ]]", ""))


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def title_words(c: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    Unlike ``initcap`` this also starts a word after an apostrophe or a hyphen.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, capitalize), "")


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def drop_parentheses(c: Column) -> Column:
    return F.regexp_replace(c, r"\([^)]*\)", "")


def drop_phrases(c: Column, phrases: Sequence[str]) -> Column:
    """Remove whole-word phrases, tried in the order given; case-sensitive."""
    return F.regexp_replace(c, r"\b(?:" + "|".join(re.escape(p) for p in phrases) + r")\b", "")


def keep_alnum_lower(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"[^a-zA-Z0-9\s]", ""))


def dashes_to_spaces_lower(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "-", " "))


def contains_ci(c: Column, query: str) -> Column:
    """Literal case-insensitive substring test; null counts as no match."""
    return F.coalesce(F.contains(F.lower(c), F.lit(query.lower())), F.lit(False))


def any_of_ci(c: Column, terms: Sequence[str]) -> Column:
    """True when at least one literal term occurs, ignoring case."""
    if not terms:
        return F.lit(False)
    quoted = "|".join(r"\Q" + t.replace(r"\E", r"\E\\E\Q") + r"\E" for t in terms)
    return F.coalesce(F.rlike(c, F.lit(f"(?iu)(?:{quoted})")), F.lit(False))


def once(c: Column, value: Callable[[Column], Column]) -> Column:
    """``value`` of a column that is worked out once, however often ``value`` names it."""
    return F.get(F.transform(F.array(c), value), F.lit(0))


def first_like(c: Column, rules: Sequence[tuple[str, str]], default: Column) -> Column:
    """Value of the first rule whose substring occurs in ``c`` (order matters)."""
    chain = None
    for needle, value in rules:
        test = F.contains(c, F.lit(needle))
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return default if chain is None else chain.otherwise(default)


def decode_entities(c: Column) -> Column:
    """The HTML entities that occur in scraped product text; ``&amp;`` last."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                       ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def strip_tags(c: Column) -> Column:
    """Text of an HTML fragment, entities decoded, on one line."""
    plain = decode_entities(F.regexp_replace(c, r"(?s)<[^>]*>", " "))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


# Quantity and unit words removed from ingredient text, in matching order.
INGREDIENT_UNITS = (
    "g", "oz", "ml", "tsp", "tbs", "cups", "pint", "quart", "l", "lb", "kg",
    "teaspoon", "tablespoon", "medium", "cup", "/", "-",
)
# Fixed value: other ingredient fragments removed.
INGREDIENT_FRAGMENTS = r"¼\s*|½\s*|¾\s*|to serve|Handful\s*"


def clean_ingredients(ingredients: Column, compat: bool = False) -> Column:
    """Join an ingredient array and drop amounts, units, fractions and trailing junk.

    A unit only counts when a word ends there, so "10 litres gas" keeps "litres".
    ``compat=True`` lets a unit match the head of a longer word, as the original
    cleaning rule did ("itres gas").
    """
    units = [u if compat or not u.isalpha() else u + r"\b" for u in INGREDIENT_UNITS]
    amount = r"\d+\s*(?:" + "|".join(units) + r")?\s*"
    pattern = f"(?iu){amount}|{INGREDIENT_FRAGMENTS}"
    joined = F.concat_ws(", ", ingredients)
    return F.trim(F.regexp_replace(F.regexp_replace(joined, pattern, ""), r"[\s,-]*$", ""))
