"""Price text and currency rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Euro per unit of currency.
EUR_PER = {"INR": 0.011, "GBP": 1.16}

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def plain_number(c: Column) -> Column:
    """Double from digits with optional thousands commas; anything else is null."""
    bare = F.regexp_replace(c, ",", "")
    return F.when(F.rlike(bare, F.lit(_NUMBER)), bare.try_cast("double"))


def convert(c: Column, currency: str) -> Column:
    return F.round(c * F.lit(EUR_PER[currency]), 2)


def _pounds(token: Column) -> Column:
    in_pounds = plain_number(F.substr(token, F.lit(2)))
    in_pence = plain_number(F.substr(token, F.lit(1), F.length(token) - 1)) / 100
    return F.when(F.startswith(token, F.lit("£")), in_pounds).otherwise(in_pence)


def gbp_text_to_eur(c: Column) -> Column:
    """"£1.50", "75p" or "3 for £2.00" to euro per unit; unreadable text gives 0."""
    words = F.split(c, " ")
    count = F.get(words, F.lit(0)).try_cast("int")
    per_unit = F.when(
        F.size(words) > 1,
        F.when(count != 0, _pounds(F.get(words, F.lit(2))) / count),
    ).otherwise(_pounds(c))
    return F.coalesce(per_unit * EUR_PER["GBP"], F.lit(0.0))


def inr_text_to_eur(c: Column) -> Column:
    """Rupee digits, commas allowed, to euro; unreadable text gives 0."""
    return F.coalesce(plain_number(c) * EUR_PER["INR"], F.lit(0.0))


def spec_sentence(specs: Column) -> Column:
    """Every entry preceded by one space; a null list becomes a stock phrase."""
    joined = F.array_join(F.transform(specs, lambda s: F.concat(F.lit(" "), s)), "")
    return F.when(specs.isNotNull() & ~F.exists(specs, lambda s: s.isNull()), joined).otherwise(
        "no description available"
    )


def rupee_block(c: Column) -> Column:
    """Split "₹selling₹actualNN% off" into selling, actual and discount text.

    The discount sits in the last seven characters of the second amount. Prices
    are compared as numbers, so the smaller is always the selling price.
    """
    parts = F.split(c, "₹")
    first, second = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    tail = F.greatest(F.length(second) - 7, F.lit(0))
    actual = F.coalesce(F.substr(second, F.lit(1), tail), first)
    discount = F.coalesce(F.substr(F.right(second, F.lit(7)), F.lit(1), F.lit(2)), F.lit("0"))
    a, b = plain_number(first), plain_number(actual)
    return F.struct(
        F.least(a, b).alias("selling_price"),
        F.when(a.isNotNull(), F.greatest(a, b)).alias("actual_price"),
        F.when(first.isNotNull(), discount).alias("discount"),
    )


def pair_spec_lines(specs: Column) -> Column:
    """Drop the last block, then join the lines of every block two by two."""
    kept = F.when(F.size(specs) > 0, F.slice(specs, F.lit(1), F.size(specs) - 1))

    def pairs(block: Column) -> Column:
        lines = F.split(block, "\n")
        starts = F.sequence(F.lit(1), F.size(lines), F.lit(2))
        return F.transform(starts, lambda i: F.array_join(F.slice(lines, i, F.lit(2)), " "))

    return F.coalesce(F.flatten(F.transform(kept, pairs)), F.array().cast("array<string>"))


def discounted(price: Column, share_used: Column, rate: Column) -> Column:
    """Resale asking price: the used share lowers the price at ``rate``."""
    return price * (1 - share_used * rate)
