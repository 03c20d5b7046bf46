"""Prices on the resale platform."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.functions.dates import parse_iso
from larder.functions.money import discounted
from larder.functions.pricing import PricingRules, dynamic_price, longevity, retail_price


def with_holiday_flag(df: DataFrame, holidays: DataFrame, date: str, country: str, out: str = "is_holiday") -> DataFrame:
    """Whether the date is a public holiday of the country."""
    days = (
        holidays.where(F.col("country") == country)
        .select(F.col("date").alias(date)).distinct().withColumn(out, F.lit(True))
    )
    return df.join(days, date, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def is_holiday(holidays: DataFrame, as_of: str, country: str):
    """The same question for one day, as a scalar column."""
    same_day = (F.col("country") == country) & (F.col("date") == F.lit(as_of).cast("date"))
    return holidays.agg(F.coalesce(F.max(F.when(same_day, True)), F.lit(False))).scalar()


def resale_offers(df: DataFrame, rate: float | str = 0.3) -> DataFrame:
    """Asking price of a partly used item; ``rate`` (0.1-0.5) is a number or a column name."""
    r = F.col(rate) if isinstance(rate, str) else F.lit(rate)
    price = F.col("unit_price").try_cast("double")
    return df.withColumn("unit_price", price).withColumn(
        "expected_price", discounted(price, F.col("percentage_consumed"), r)
    )


def price_unsold(
    df: DataFrame, as_of: str, rules: PricingRules = PricingRules(), holidays: DataFrame | None = None,
    country: str = "ES", compat: bool = False,
) -> DataFrame:
    """Days left, longevity and dynamic price of unsold items; sold items get nulls.

    One pass without a split and union. ``compat=True`` applies the longevity
    curve to its own result, as the original job does.
    """
    unsold = F.col("selling_date").isNull() & F.col("buying_customer_id").isNull()
    left = F.datediff(parse_iso(F.col("expected_expiry_date")), F.lit(as_of).cast("date"))
    scale = longevity(F.col("avg_expiry_days"))
    holiday = F.lit(False) if holidays is None else is_holiday(holidays, as_of, country)
    return (
        df.withColumn("days_to_expiry", F.when(unsold, left))
        .withColumn("longevity_scale", F.when(unsold, scale))
        .withColumn("dynamic_price", F.when(unsold, dynamic_price(
            F.col("days_to_expiry"), F.col("percentage_consumed"), F.col("unit_price"),
            longevity(F.col("longevity_scale")) if compat else F.col("longevity_scale"), holiday, rules,
        )))
    )


def retail_prices(df: DataFrame) -> DataFrame:
    """Price of goods sold in a shop by the days between purchase and expiry ("d MMM yyyy")."""
    return df.withColumn("dynamic_price", retail_price(
        F.col("unit_price").try_cast("double"), parse_iso(F.col("purchase_date")),
        F.try_to_date(F.col("expiry_date"), "d MMM yyyy"),
    ))
