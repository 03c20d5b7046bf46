"""Cleaning, dimensions, facts and KPIs on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog import inputs as i
from larder.catalog.inputs import AS_OF, RUN_TS, digest_sql, with_ctes
from larder.operators.stats import match_audit
from larder.plans import cleaning, kpis, star
from larder.plans.pricing import price_unsold, resale_offers
from larder.plans.reviews import score_reviews
from larder.session import materialize


def customers(s, d):
    return cleaning.clean_customers(i.customers(s, d))


def links(s, d):
    return cleaning.clean_customer_location(i.customer_location(s, d))


def locations(s, d):
    return cleaning.clean_location(i.locations(s, d))


def establishments(s, d):
    return cleaning.clean_establishments(i.establishments(s, d))


def purchases(s, d):
    return cleaning.clean_purchases(i.purchases(s, d))


def sold_names(s, d):
    """Distinct (product, day) pairs of the purchases, stored: all the product and the
    date dimension need, so the purchases are joined once for both."""
    return materialize(i.purchases(s, d).select("product_name", "purchase_date").distinct(), "sold")


def dim_product(s, d):
    return star.dim_product(i.purchases(s, d), RUN_TS)


def dim_date(s, d):
    return star.dim_date(i.purchases(s, d), RUN_TS)


def products_and_dates(s, d):
    sold = sold_names(s, d)
    return star.dim_product(sold, RUN_TS), star.dim_date(sold, RUN_TS)


def dim_customer(s, d):
    return star.dim_customer(customers(s, d), links(s, d), locations(s, d), RUN_TS)


def dim_customer_location(s, d):
    return star.dim_customer_location(customers(s, d), links(s, d), locations(s, d), RUN_TS)


def dim_store_location(s, d):
    return star.dim_store_location(establishments(s, d), RUN_TS)


def dim_store(s, d):
    return star.dim_store(establishments(s, d), dim_store_location(s, d), RUN_TS)


def stored_customers(s, d):
    """The customer dimension as a stored table. Spark splits the hot keys of a join only
    when both sides come straight out of a shuffle; a dimension still being aggregated
    and joined in the same plan would keep it from doing so."""
    return materialize(dim_customer(s, d), "customers")


def stored_stores(s, d):
    return materialize(dim_store(s, d), "stores")


def stored_purchases(s, d):
    """Cleaned purchases as a stored table: dimensions and facts all read it."""
    return materialize(purchases(s, d), "purchases")


def fact_inventory(s, d, stored=None):
    bought = stored or stored_purchases(s, d)
    return star.fact_customer_inventory(bought, star.dim_product(bought, RUN_TS), stored_customers(s, d), RUN_TS)


def fact_and_dates(s, d):
    bought = stored_purchases(s, d)
    return fact_inventory(s, d, bought), star.dim_date(bought, RUN_TS)


def fact_store_inventory(s, d):
    return star.fact_store_inventory(i.stock(s, d), stored_stores(s, d), dim_product(s, d), RUN_TS)


def _priced_offers(s, d):
    return price_unsold(resale_offers(i.offers(s, d)), AS_OF)


def fact_customer_sale(s, d):
    products, dates = products_and_dates(s, d)
    fact = star.fact_customer_sale(_priced_offers(s, d), stored_customers(s, d), products, dates, RUN_TS)
    return fact.withColumns({c: F.round(c, 6) for c in ("expected_price", "dynamic_price")})


def fact_store_sale(s, d):
    products, dates = products_and_dates(s, d)
    fact = star.fact_store_sale(i.store_sales(s, d), stored_stores(s, d), products, dates, stored_customers(s, d), RUN_TS)
    return fact.withColumn("dynamic_price", F.round("dynamic_price", 6))


def scored_reviews(s, d):
    return score_reviews(i.reviews(s, d), i.DEMO_POSITIVE, i.DEMO_NEGATIVE)


def rounded_reviews(s, d):
    """Scored reviews with rounded scores: rounded here, not once for every pair a review is part of.

    Facts hold no texts, so these are scored before the ratings are joined, which would shuffle them.
    """
    scored = score_reviews(i.review_texts(s, d), i.DEMO_POSITIVE, i.DEMO_NEGATIVE, ratings=i.ratings(s, d), key="doc_id")
    return scored.fillna({"verified": "No"}).withColumn("sentiment_score", F.round("sentiment_score", 6))


def fact_store_review(s, d):
    return star.fact_store_review(i.store_goods(s, d), rounded_reviews(s, d), RUN_TS, "doc_id")


def fact_customer_review(s, d):
    bought = stored_purchases(s, d)
    return star.fact_customer_review(bought, rounded_reviews(s, d), star.dim_product(bought, RUN_TS), RUN_TS, "doc_id")


def fact_customer_review_numbered(s, d):
    bought = stored_purchases(s, d)
    fact = star.fact_customer_review(
        bought, scored_reviews(s, d), star.dim_product(bought, RUN_TS), RUN_TS, "doc_id", numbered=True
    )
    return fact.select("review_id", "customer_id", "product_id", "date_id")


def kpi_view(s, d):
    kpis.register_views(s, {"fact_cust_inventory": fact_inventory(s, d)})
    return kpis.lifetime_value_view(s)


QUERIES = {
    "clean_customers": customers,
    "clean_customer_location": links,
    "clean_locations": locations,
    "clean_establishments": establishments,
    "clean_purchases": purchases,
    "clean_purchases_numbered": lambda s, d: cleaning.clean_purchases(i.purchases(s, d), numbered=True),
    "dim_product": dim_product,
    "dim_date": dim_date,
    "dim_customer": dim_customer,
    "dim_customer_location": dim_customer_location,
    "dim_store": dim_store,
    "dim_store_location": dim_store_location,
    "fact_customer_inventory": fact_inventory,
    "fact_store_inventory": fact_store_inventory,
    "fact_c2c_purchase": fact_customer_sale,
    "fact_b2c_purchase": fact_store_sale,
    "fact_store_review": fact_store_review,
    "fact_customer_review": fact_customer_review,
    "fact_customer_review_numbered": fact_customer_review_numbered,
    "kpi_active_customers": lambda s, d: kpis.active_customers(*fact_and_dates(s, d)),
    "kpi_new_customers": lambda s, d: kpis.first_time_customers(*fact_and_dates(s, d)),
    "kpi_retention": lambda s, d: kpis.retention(*fact_and_dates(s, d)),
    "kpi_clv": lambda s, d: kpis.average_lifetime_value(fact_inventory(s, d)),
    "kpi_clv_view": kpi_view,
    "kpi_churn": lambda s, d: kpis.churn(*fact_and_dates(s, d), AS_OF),
    "sentiment_lexicon": lambda s, d: scored_reviews(s, d).select(
        "doc_id", "Sentiment", "sentiment_label", F.round("sentiment_score", 6).alias("sentiment_score")
    ),
    "match_audit": lambda s, d: match_audit(i.reviews(s, d), i.stock(s, d), "business_name", "store_name"),
}

_STAMP = f"'{RUN_TS}' AS created_on"
# Price rule constants restated from the rule defaults.
_DYNAMIC = """CASE WHEN buyer IS NULL THEN round(greatest(unit_price * (1 - least(1.0,
    (CASE WHEN expiry - DATE '2001-06-30' > 30 THEN 0.15 WHEN expiry - DATE '2001-06-30' > 10 THEN 0.3
          WHEN percentage_consumed > 0.5 THEN 0.5 ELSE 0.4 END) * 2 * exp(-avg_expiry_days / 365.0))), 1.0), 6) END"""

ORACLES = {
    "clean_customers": with_ctes("SELECT DISTINCT * FROM customers", "customers"),
    "clean_customer_location": with_ctes("SELECT DISTINCT * FROM customer_location", "customer_location"),
    "clean_locations": with_ctes("SELECT * FROM locations", "locations"),
    "clean_establishments": with_ctes("SELECT * FROM clean_est", "clean_est"),
    "clean_purchases": with_ctes("SELECT * FROM clean_purch", "clean_purch"),
    "clean_purchases_numbered": with_ctes("""
        SELECT row_number() OVER (ORDER BY customer_id, purchase_date, customer_name, product_name, unit_price, quantity) - 1 AS id,
               customer_id, customer_name, product_name, replace(unit_price, ',', '') AS unit_price, quantity, purchase_date
        FROM (SELECT DISTINCT * FROM purchases)""", "purchases"),
    "dim_product": with_ctes(f"SELECT *, {_STAMP} FROM dim_products", "dim_products"),
    "dim_date": with_ctes(f"SELECT *, {_STAMP} FROM dim_dates", "dim_dates"),
    "dim_customer": with_ctes(f"SELECT *, {_STAMP} FROM dim_customers", "dim_customers"),
    "dim_customer_location": with_ctes(f"""
        SELECT location_id, min(postal_code) AS postal_code, min(place_name) AS place_name,
               min(latitude) AS latitude, min(longitude) AS longitude, {_STAMP}
        FROM customers JOIN customer_location USING (customer_id) JOIN locations USING (location_id)
        GROUP BY location_id""", "customers", "customer_location", "locations"),
    "dim_store": with_ctes(f"SELECT *, {_STAMP} FROM dim_stores", "dim_stores"),
    "dim_store_location": with_ctes(f"SELECT *, {_STAMP} FROM dim_places", "dim_places"),
    "fact_customer_inventory": with_ctes(f"SELECT *, {_STAMP} FROM fact_inv", "fact_inv"),
    "fact_store_inventory": with_ctes(f"""
        SELECT row_number() OVER (ORDER BY product_name, supermarket_id, price, quantity, expiry_date_id, location_id) AS supermarket_inventory_id,
               supermarket_id, location_id, product_id, price, quantity, expiry_date_id, {_STAMP}
        FROM (SELECT s.product_name, store_id AS supermarket_id, location_id, p.product_id, price, quantity,
                     replace(expiry_date, '-', '') AS expiry_date_id
              FROM stock s JOIN dim_stores ON store_id = supermarket_id JOIN dim_products p USING (product_name))""",
        "stock", "dim_stores", "dim_products"),
    "fact_c2c_purchase": with_ctes(f"""
        SELECT o.id, o.customer_id AS selling_customer_id, o.buyer AS buying_customer_id,
               s.location_id AS seller_location_id, b.location_id AS buyer_location_id,
               t.date_id AS selling_date_id, p.product_id, unit_price, quantity,
               round(unit_price * (1 - percentage_consumed * 0.3), 6) AS expected_price,
               {_DYNAMIC} AS dynamic_price, {_STAMP}
        FROM offers o LEFT JOIN dim_customers b ON o.buyer = b.customer_id
        LEFT JOIN dim_customers s ON o.customer_id = s.customer_id
        LEFT JOIN dim_products p USING (product_name) LEFT JOIN dim_dates t ON o.sold_on = t.date""",
        "offers", "dim_customers", "dim_products", "dim_dates"),
    "fact_b2c_purchase": with_ctes(f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS store_id, o_custkey AS customer_id, m.location_id,
               c.location_id AS buyer_location_id, p.product_id, t.date_id AS purchase_date_id,
               p_retailprice AS unit_price, CAST(l_quantity AS INTEGER) AS quantity,
               round(CASE WHEN l_linenumber = 7 THEN p_retailprice
                     ELSE p_retailprice * greatest(0.1, least(1.0, p_size * 5 / 365.0)) END, 6) AS dynamic_price, {_STAMP}
        FROM sold_parts JOIN dim_stores m ON CAST(l_suppkey AS VARCHAR) = m.supermarket_id
        LEFT JOIN dim_products p ON p.product_name = p_name
        LEFT JOIN dim_dates t ON t.date = CAST(o_orderdate AS DATE)
        LEFT JOIN dim_customers c ON c.customer_id = o_custkey""",
        "sold_parts", "dim_stores", "dim_products", "dim_dates", "dim_customers"),
    "fact_store_review": with_ctes(f"""
        SELECT {digest_sql('store_id', 'product_id', 'doc_id')} AS review_id, store_id, product_id,
               strftime(day, '%Y%m%d') AS date_id, sentiment_label, round(sentiment_score, 6) AS sentiment_score, {_STAMP}
        FROM (SELECT DISTINCT store_name, store_id, product_id FROM stock) JOIN scored ON store_name = business_name""",
        "stock", "scored"),
    "fact_customer_review": with_ctes(f"""
        SELECT {digest_sql('id', 'doc_id')} AS review_id, customer_id, product_id,
               replace(purchase_date, '-', '') AS date_id, sentiment_label,
               round(sentiment_score, 6) AS sentiment_score, {_STAMP}
        FROM clean_purch JOIN scored ON customer_name = user_name JOIN dim_products USING (product_name)""",
        "clean_purch", "scored", "dim_products"),
    "fact_customer_review_numbered": with_ctes("""
        SELECT 19999 + row_number() OVER (ORDER BY customer_id, product_id, date_id, id, doc_id) AS review_id,
               customer_id, product_id, date_id
        FROM (SELECT *, replace(purchase_date, '-', '') AS date_id FROM clean_purch)
        JOIN reviews ON customer_name = user_name JOIN dim_products USING (product_name)""",
        "clean_purch", "reviews", "dim_products"),
    "kpi_active_customers": with_ctes("""
        SELECT year, month, count(DISTINCT customer_id) AS new_customers
        FROM fact_inv JOIN dim_dates ON purchase_date_id = CAST(date_id AS VARCHAR) GROUP BY year, month""",
        "fact_inv", "dim_dates"),
    "kpi_new_customers": with_ctes("""
        SELECT CAST(year(f) AS INTEGER) AS year, CAST(month(f) AS INTEGER) AS month, count(*) AS first_time_customers
        FROM (SELECT customer_id, min(strptime(purchase_date_id, '%Y%m%d')) AS f FROM fact_inv GROUP BY customer_id)
        GROUP BY 1, 2""", "fact_inv"),
    "kpi_retention": with_ctes("""
        , firsts AS (SELECT customer_id, min(purchase_date_id) AS f FROM fact_inv GROUP BY customer_id),
        repeats AS (SELECT customer_id, d.year, d.month FROM fact_inv JOIN firsts USING (customer_id)
                    JOIN dim_dates d ON purchase_date_id = CAST(d.date_id AS VARCHAR) WHERE purchase_date_id > f)
        SELECT d.year, d.month, count(DISTINCT customer_id) AS repeat_customers
        FROM repeats r JOIN dim_dates d ON r.year = d.year AND r.month = d.month GROUP BY d.year, d.month""",
        "fact_inv", "dim_dates"),
    "kpi_clv": with_ctes("""
        SELECT round(avg(total), 6) AS average_clv FROM (
            SELECT sum(quantity * CAST(unit_price AS DOUBLE)) AS total FROM fact_inv GROUP BY customer_id)""", "fact_inv"),
    "kpi_clv_view": with_ctes("""
        SELECT round(avg(total), 6) AS average_clv FROM (
            SELECT sum(quantity * CAST(unit_price AS DOUBLE)) AS total FROM fact_inv GROUP BY customer_id)""", "fact_inv"),
    "kpi_churn": with_ctes("""
        SELECT CAST(year(l) AS INTEGER) AS year, CAST(month(l) AS INTEGER) AS month, count(*) AS churned_customers
        FROM (SELECT customer_id, max(strptime(purchase_date_id, '%Y%m%d')) AS l FROM fact_inv GROUP BY customer_id)
        WHERE l < DATE '2001-06-30' - INTERVAL 1 MONTH GROUP BY 1, 2""", "fact_inv"),
    "sentiment_lexicon": with_ctes("""
        SELECT doc_id, CASE WHEN rating <= 3 THEN 0 ELSE 1 END AS "Sentiment", sentiment_label,
               round(sentiment_score, 6) AS sentiment_score FROM scored""", "scored"),
    "match_audit": with_ctes("""
        SELECT count(*) FILTER (WHERE business_name IN (SELECT store_name FROM stock)) AS matched,
               count(*) FILTER (WHERE business_name NOT IN (SELECT store_name FROM stock)) AS unmatched
        FROM reviews""", "reviews", "stock"),
}
