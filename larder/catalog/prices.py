"""Dynamic, retail and resale prices, and the price dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog import inputs as i
from larder.catalog.inputs import AS_OF, with_ctes
from larder.operators.stats import count_and_mean, histogram, mean_by, summary, trend_line
from larder.plans.browse import best_scored, price_view
from larder.plans.pricing import price_unsold, resale_offers, retail_prices, with_holiday_flag

_SHOWN = ("id", "days_to_expiry", "longevity_scale", "dynamic_price")


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("longevity_scale", "dynamic_price")})


def dynamic(s, d, **options):
    return _rounded(price_unsold(i.offers(s, d), AS_OF, **options).select(*_SHOWN))


def retail(s, d):
    priced = retail_prices(i.store_sales(s, d))
    return priced.groupBy("product_name").agg(
        F.count("*").alias("n"), F.round(F.sum("dynamic_price"), 4).alias("total"),
        F.round(F.min("dynamic_price"), 6).alias("lowest"),
    )


def resale(s, d):
    rate = F.col("quantity") / 100 + 0.1
    offers = resale_offers(i.offers(s, d).withColumn("rate", rate), "rate")
    return offers.select("id", "unit_price", F.round("expected_price", 6).alias("expected_price"))


def holiday_flag(s, d):
    flagged = with_holiday_flag(
        i.offers(s, d).withColumn("day", F.col("purchase_date").cast("date")), i.holidays(s, d), "day", "ES"
    )
    return flagged.groupBy("is_holiday").agg(F.count("*").alias("n"))


def view(s, d):
    """Priced items, valued half a year before the last expiry so that days left spread out."""
    priced = price_unsold(i.offers(s, d).withColumn("score", F.col("quantity") * 2), "2000-01-01")
    return price_view(priced, (0, 365), (0.0, 1.0), (0.0, 2000.0))


def best(s, d):
    return best_scored(view(s, d), ["id", "product_name", "days_to_expiry"])


def stats(s, d):
    return summary(view(s, d), ["dynamic_price", "days_to_expiry", "percentage_consumed"], 4)


QUERIES = {
    "dynamic_price": dynamic,
    "dynamic_price_compat": lambda s, d: dynamic(s, d, compat=True),
    "dynamic_price_holiday": lambda s, d: _rounded(
        price_unsold(i.offers(s, d), "2001-06-01", holidays=i.holidays(s, d)).select(*_SHOWN)),
    "retail_price": retail,
    "resale_price": resale,
    "holiday_flag": holiday_flag,
    "price_view": lambda s, d: view(s, d).select(
        "id", "days_to_expiry", F.round("dynamic_price", 6).alias("dynamic_price"),
        F.round("percentage_decrease", 6).alias("percentage_decrease")),
    "price_summary": stats,
    "price_metrics": lambda s, d: count_and_mean(view(s, d), "dynamic_price"),
    "price_histogram": lambda s, d: histogram(view(s, d), "unit_price"),
    "price_by_group": lambda s, d: mean_by(
        view(s, d).withColumn("consumed", F.round("percentage_consumed", 2)), "consumed", "dynamic_price", "mean_price"),
    "price_trend": lambda s, d: trend_line(view(s, d), "days_to_expiry", "percentage_decrease", 4),
    "price_full_score": best,
}


def _priced(as_of: str, compat: bool = False, holiday: str = "1.0") -> str:
    scale = "2 * exp(-avg_expiry_days / 365.0)"
    used = f"(2 * exp(-({scale}) / 365.0))" if compat else f"({scale})"
    return f"""
        SELECT id, product_name, unit_price, quantity, percentage_consumed,
               CASE WHEN buyer IS NULL THEN CAST(expiry - DATE '{as_of}' AS INTEGER) END AS days_to_expiry,
               CASE WHEN buyer IS NULL THEN {scale} END AS longevity_scale,
               CASE WHEN buyer IS NULL THEN greatest(unit_price * (1 - least(1.0, {holiday} * {used} *
                   CASE WHEN expiry - DATE '{as_of}' > 30 THEN 0.15 WHEN expiry - DATE '{as_of}' > 10 THEN 0.3
                        WHEN percentage_consumed > 0.5 THEN 0.5 ELSE 0.4 END)), 1.0) END AS dynamic_price
        FROM offers"""


def _listed(inner: str) -> str:
    return with_ctes(f"""
        SELECT id, days_to_expiry, round(longevity_scale, 6) AS longevity_scale, round(dynamic_price, 6) AS dynamic_price
        FROM ({inner})""", "offers")


_VIEW = f"""
    SELECT *, (unit_price - dynamic_price) / unit_price * 100 AS percentage_decrease
    FROM ({_priced('2000-01-01')})
    WHERE days_to_expiry BETWEEN 0 AND 365 AND percentage_consumed BETWEEN 0 AND 1 AND dynamic_price BETWEEN 0 AND 2000"""
_HOLIDAY = """(CASE WHEN EXISTS (SELECT 1 FROM orders h WHERE CAST(h.o_orderdate AS DATE) = DATE '2001-06-01') THEN 1.2 ELSE 1.0 END)"""

ORACLES = {
    "dynamic_price": _listed(_priced(AS_OF)),
    "dynamic_price_compat": _listed(_priced(AS_OF, compat=True)),
    "dynamic_price_holiday": _listed(_priced("2001-06-01", holiday=_HOLIDAY)),
    "retail_price": """
        SELECT p_name AS product_name, count(*) AS n, round(sum(v), 4) AS total, round(min(v), 6) AS lowest
        FROM (SELECT p_name, CASE WHEN l_linenumber = 7 THEN p_retailprice
                     ELSE p_retailprice * greatest(0.1, least(1.0, p_size * 5 / 365.0)) END AS v
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
        GROUP BY p_name""",
    "resale_price": with_ctes("""
        SELECT id, unit_price, round(unit_price * (1 - percentage_consumed * (quantity / 100.0 + 0.1)), 6) AS expected_price
        FROM offers""", "offers"),
    "holiday_flag": """
        SELECT day(o_orderdate) = 1 AS is_holiday, count(*) AS n
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "price_view": with_ctes(f"""
        SELECT id, days_to_expiry, round(dynamic_price, 6) AS dynamic_price,
               round(percentage_decrease, 6) AS percentage_decrease FROM ({_VIEW})""", "offers"),
    "price_summary": with_ctes(f"""
        , v AS (SELECT 'dynamic_price' AS c, dynamic_price AS x FROM ({_VIEW})
                UNION ALL SELECT 'days_to_expiry', days_to_expiry FROM ({_VIEW})
                UNION ALL SELECT 'percentage_consumed', percentage_consumed FROM ({_VIEW}))
        SELECT c AS "column", statistic, round(value, 4) AS value FROM (
            SELECT c, 'count' AS statistic, CAST(count(x) AS DOUBLE) AS value FROM v GROUP BY c
            UNION ALL SELECT c, 'mean', avg(x) FROM v GROUP BY c UNION ALL SELECT c, 'std', stddev_samp(x) FROM v GROUP BY c
            UNION ALL SELECT c, 'min', min(x) FROM v GROUP BY c UNION ALL SELECT c, 'max', max(x) FROM v GROUP BY c
            UNION ALL SELECT c, '25%', quantile_cont(x, 0.25) FROM v GROUP BY c
            UNION ALL SELECT c, '50%', quantile_cont(x, 0.5) FROM v GROUP BY c
            UNION ALL SELECT c, '75%', quantile_cont(x, 0.75) FROM v GROUP BY c)""", "offers"),
    "price_metrics": with_ctes(f"""
        SELECT count(*) AS total_items, round(avg(dynamic_price), 4) AS average FROM ({_VIEW})""", "offers"),
    "price_histogram": with_ctes(f"""
        , v AS (SELECT unit_price AS x FROM ({_VIEW})), b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
        SELECT CAST(least(floor((x - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
        FROM v, b GROUP BY 1""", "offers"),
    "price_by_group": with_ctes(f"""
        SELECT round(percentage_consumed, 2) AS consumed, round(avg(dynamic_price), 4) AS mean_price
        FROM ({_VIEW}) GROUP BY 1""", "offers"),
    "price_trend": with_ctes(f"""
        SELECT count(*) AS n, round(regr_slope(percentage_decrease, days_to_expiry), 4) AS slope,
               round(regr_intercept(percentage_decrease, days_to_expiry), 4) AS intercept,
               round(regr_r2(percentage_decrease, days_to_expiry), 4) AS r2 FROM ({_VIEW})""", "offers"),
    "price_full_score": with_ctes(f"""
        SELECT id, product_name, days_to_expiry FROM ({_VIEW}) WHERE quantity * 2 = 100""", "offers"),
}
