"""Price rules as expressions. Nulls are handled explicitly: least/greatest skip them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Consumption cut-off and days in the longevity and retail rules.
CONSUMPTION_CUTOFF = 0.5
YEAR_DAYS = 365
RETAIL_FACTOR_RANGE = (0.1, 1.0)


@dataclass(frozen=True)
class PricingRules:
    """Defaults are ours; the rule file of the original jobs is not published."""

    holiday_discount: float = 1.2
    threshold_days_high: int = 30
    threshold_days_medium: int = 10
    discount_high: float = 0.3
    discount_medium: float = 0.15
    discount_low_high_consumption: float = 0.5
    discount_low_low_consumption: float = 0.4
    min_price: float = 1.0


def longevity(days: Column) -> Column:
    return 2 * F.exp(-days / YEAR_DAYS)


def dynamic_price(
    days_left: Column, consumed: Column, price: Column, longevity_scale: Column,
    is_holiday: Column, rules: PricingRules,
) -> Column:
    share = (
        F.when(days_left > rules.threshold_days_high, rules.discount_medium)
        .when(days_left > rules.threshold_days_medium, rules.discount_high)
        .when(consumed > CONSUMPTION_CUTOFF, rules.discount_low_high_consumption)
        .otherwise(rules.discount_low_low_consumption)
    )
    total = share * longevity_scale * F.when(is_holiday, rules.holiday_discount).otherwise(1.0)
    known = days_left.isNotNull() & longevity_scale.isNotNull() & price.isNotNull()
    return F.when(
        known,
        F.greatest(price * (1 - F.least(total, F.lit(1.0))), F.lit(rules.min_price)),
    )


def retail_price(price: Column, bought: Column, expires: Column) -> Column:
    """Unit price scaled by the days left, within 10% and 100%; unknown dates keep it."""
    low, high = RETAIL_FACTOR_RANGE
    factor = F.greatest(F.lit(low), F.least(F.lit(high), F.datediff(expires, bought) / YEAR_DAYS))
    return F.when(price.isNull() | bought.isNull() | expires.isNull(), price).otherwise(price * factor)
