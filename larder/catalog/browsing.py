"""Store search, reviews and customer pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog import inputs as i
from larder.catalog.inputs import table, with_ctes
from larder.catalog.star import scored_reviews
from larder.operators.shape import drop_incomplete
from larder.plans import cleaning
from larder.plans.browse import browse_reviews, closest_stores, map_centre, store_deals

POINTS = (("plaza", 41.3899, 2.1146), ("harbour", 38.5, 0.25), ("hill", 43.9, 4.9))


def _places(s, d):
    return cleaning.clean_establishments(i.establishments(s, d)).withColumnRenamed("id", "store_id")


def closest(s, d):
    found = closest_stores(i.stock(s, d), _places(s, d), POINTS)
    return found.select("point_id", "store_id", "store_name", "full_address", F.round("distance_km", 3).alias("distance_km"))


def closest_by_customer(s, d):
    """The stores closest to every customer's place."""
    places = i.locations(s, d).select("location_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    points = i.customer_location(s, d).join(places, "location_id").select(F.col("customer_id").alias("point_id"), "lat", "lon")
    found = closest_stores(i.stock(s, d), _places(s, d), points)
    return found.select(F.col("point_id").alias("customer_id"), "store_id", F.round("distance_km", 3).alias("distance_km"))


def baskets(s, d):
    """Each store lists ten product ids derived from its key; unknown ids find no product."""
    ids = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda n: F.col("s_suppkey") * 10 + n * 3)
    return table(s, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("store_id"), F.col("s_name").alias("store_name"), ids.alias("product_ids")
    )


def basket_products(s, d):
    return table(s, d, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_retailprice").alias("product_price")
    )


def activities(s, d):
    return i.establishments(s, d).withColumn(
        "activity_description", F.when(F.col("county_code").cast("int") % 3 == 0, "SUPERMERCATS i botigues").otherwise("forn"))


def raw_establishments(s, d):
    """The scraped form: source headings, some rows without address."""
    e = i.establishments(s, d)
    return e.select(
        F.col("id").alias("Id"), F.col("commercial_name").alias("Nom comercial"), F.col("location").alias("Localització"),
        F.when(F.col("county_code") != "3", F.col("full_address")).alias("Adreça completa"),
    )


QUERIES = {
    "closest_stores": closest,
    "closest_stores_by_customer": closest_by_customer,
    "map_centre": lambda s, d: map_centre(_places(s, d).withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")}), 4),
    "store_deals_search": lambda s, d: store_deals(i.stock(s, d), "Supplier#000000003", "RING"),
    "all_deals_search": lambda s, d: store_deals(i.stock(s, d), "Show All", "gizmo").groupBy("store_name").agg(F.count("*").alias("n")),
    "review_browser": lambda s, d: browse_reviews(
        scored_reviews(s, d), "user_name", "Positive", "Yes", (0.5, 1.0), (1, 5), "2024-05-01", "2024-06-10"
    ).select("doc_id", "business_name", "user_name", "rating", "verified", "sentiment_label",
             F.round("sentiment_score", 6).alias("sentiment_score"), F.md5("review").alias("review_digest")),
    "customer_profile": lambda s, d: cleaning.customer_profile(i.customers(s, d), i.customer_location(s, d), i.locations(s, d)),
    "store_list": lambda s, d: cleaning.store_list(i.stock(s, d)),
    "store_inventory": lambda s, d: cleaning.store_inventory(baskets(s, d), basket_products(s, d)),
    "supermarkets": lambda s, d: cleaning.supermarkets_among(activities(s, d)),
    "establishment_ingest": lambda s, d: cleaning.ingest_establishments(raw_establishments(s, d)),
    "complete_reviews": lambda s, d: drop_incomplete(i.reviews(s, d)).groupBy("rating").agg(F.count("*").alias("n")),
}

# Fixed value: kilometres.
_KM = """2 * 6371 * atan2(sqrt(h), sqrt(1 - h))"""

ORACLES = {
    "closest_stores": with_ctes(f"""
        SELECT point_id, store_id, store_name, full_address, round({_KM}, 3) AS distance_km
        FROM (SELECT *, pow(sin(radians(CAST(latitude AS DOUBLE) - lat) / 2), 2) + cos(radians(lat)) * cos(radians(CAST(latitude AS DOUBLE)))
                     * pow(sin(radians(CAST(longitude AS DOUBLE) - lon) / 2), 2) AS h
              FROM (SELECT DISTINCT store_id, store_name FROM stock) JOIN clean_est ON id = store_id,
                   (VALUES ('plaza', 41.3899, 2.1146), ('harbour', 38.5, 0.25), ('hill', 43.9, 4.9)) p(point_id, lat, lon))
        QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY {_KM}, store_id) <= 5""", "stock", "clean_est"),
    "closest_stores_by_customer": with_ctes(f"""
        SELECT customer_id, store_id, round({_KM}, 3) AS distance_km
        FROM (SELECT *, pow(sin(radians(CAST(e.latitude AS DOUBLE) - lat) / 2), 2) + cos(radians(lat)) * cos(radians(CAST(e.latitude AS DOUBLE)))
                     * pow(sin(radians(CAST(e.longitude AS DOUBLE) - lon) / 2), 2) AS h
              FROM (SELECT DISTINCT store_id FROM stock) JOIN clean_est e ON id = store_id,
                   (SELECT customer_id, latitude AS lat, longitude AS lon FROM customer_location JOIN locations USING (location_id)))
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {_KM}, store_id) <= 5""", "stock", "clean_est", "customer_location", "locations"),
    "map_centre": with_ctes("""
        SELECT round(avg(CAST(latitude AS DOUBLE)), 4) AS latitude, round(avg(CAST(longitude AS DOUBLE)), 4) AS longitude FROM clean_est""", "clean_est"),
    "store_deals_search": with_ctes("""
        SELECT * FROM stock WHERE store_name = 'Supplier#000000003' AND product_name ILIKE '%ring%'""", "stock"),
    "all_deals_search": with_ctes("SELECT store_name, count(*) AS n FROM stock WHERE product_name ILIKE '%gizmo%' GROUP BY 1", "stock"),
    "review_browser": with_ctes("""
        SELECT doc_id, business_name, user_name, rating, verified, 'Positive' AS sentiment_label,
               round(sentiment_score, 6) AS sentiment_score, md5(upper(left(text, 1)) || lower(substr(text, 2))) AS review_digest
        FROM scored WHERE sentiment_label = 'positive' AND verified = 'Yes' AND sentiment_score BETWEEN 0.5 AND 1
          AND rating BETWEEN 1 AND 5 AND day BETWEEN DATE '2024-05-01' AND DATE '2024-06-10'""", "scored"),
    "customer_profile": with_ctes("""
        SELECT * FROM customers JOIN customer_location USING (customer_id) JOIN locations USING (location_id)""",
        "customers", "customer_location", "locations"),
    "store_list": with_ctes("SELECT DISTINCT store_id, store_name FROM stock", "stock"),
    "store_inventory": """
        SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, p_partkey AS product_id, p_name AS product_name,
               p_retailprice AS product_price
        FROM supplier, generate_series(0, 9) g(n) JOIN part ON p_partkey = s_suppkey * 10 + n * 3""",
    "supermarkets": with_ctes("SELECT id, commercial_name FROM establishments WHERE CAST(county_code AS INTEGER) % 3 = 0", "establishments"),
    "establishment_ingest": with_ctes("""
        SELECT id, commercial_name, location, full_address FROM establishments WHERE county_code <> '3'""", "establishments"),
    "complete_reviews": with_ctes("SELECT rating, count(*) AS n FROM reviews WHERE rating IS NOT NULL AND text IS NOT NULL GROUP BY 1", "reviews"),
}
