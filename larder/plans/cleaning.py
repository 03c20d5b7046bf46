"""Cleaned entity tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from larder.operators.keys import content_key, dense_key
from larder.operators.shape import drop_incomplete, rename, require


def clean_customers(raw: DataFrame) -> DataFrame:
    return require(raw, ["customer_id", "customer_name", "email_id"]).dropDuplicates()


def clean_customer_location(raw: DataFrame) -> DataFrame:
    return require(raw, ["customer_id", "location_id"]).dropDuplicates()


def clean_location(raw: DataFrame) -> DataFrame:
    """Complete locations; repeated rows stay. ``place_name`` is kept when present,
    because the customer location dimension needs it."""
    wanted = ["location_id", "postal_code", "place_name", "latitude", "longitude"]
    return drop_incomplete(raw.select(*[c for c in wanted if c in raw.columns]))


def clean_establishments(raw: DataFrame) -> DataFrame:
    """Distinct establishments with ``location`` "lat,lon" as two numbers; incomplete rows go."""
    parts = F.split("location", ",")
    fields = ["id", "commercial_name", "county_code", "full_address", "UTMx", "UTMy"]
    return drop_incomplete(
        require(raw, [*fields, "location"]).dropDuplicates().select(
            *fields,
            F.get(parts, F.lit(0)).try_cast("float").alias("latitude"),
            F.get(parts, F.lit(1)).try_cast("float").alias("longitude"),
        )
    )


PURCHASE_COLUMNS = ("customer_id", "customer_name", "product_name", "unit_price", "quantity", "purchase_date")


def clean_purchases(raw: DataFrame, numbered: bool = False) -> DataFrame:
    """Distinct purchases with an id and a unit price without thousands commas.

    The id is a digest of the row: stable on retry and free of any shuffle.
    ``numbered=True`` gives dense whole numbers from 0 instead, at the cost of
    sorting and writing the table once.
    """
    rows = require(raw, PURCHASE_COLUMNS).dropDuplicates()
    if numbered:
        order = ["customer_id", "purchase_date", *[c for c in rows.columns if c not in ("customer_id", "purchase_date")]]
        rows = dense_key(rows, order, "id", start=0)
    else:
        rows = rows.withColumn("id", content_key(*rows.columns))
    return rows.withColumn("unit_price", F.regexp_replace("unit_price", ",", "")).select("id", *PURCHASE_COLUMNS)


# Headings of the public establishment register and the column names used here.
ESTABLISHMENT_HEADINGS = {
    "Id": "id",
    "Nom comercial": "commercial_name",
    "Nom raó Social": "social_name",
    "NIF raó social": "company_NIF",
    "Descripció de l'activitat": "activity_description",
    "Identificador de l'activitat": "activity_identifier",
    "Nom de l'ens": "registration_entity",
    "Codi INE": "INE_code",
    "Ens relacionat": "ENS_relation",
    "Codi de comarca": "county_code",
    "Adreça completa": "full_address",
    "Localització": "location",
    "Tipus de via": "road_type",
    "Nom de la via": "street_name",
    "Número via": "street_number",
    "Escala": "scale",
    "Pis": "location_info_1",
    "Porta": "location_info_2",
    "Tipus de nucli": "core_type",
    "Codi postal": "postage_pick_up",
    "Municipi": "municipality",
    "Altres activitats": "other_activities",
    "Sector econòmic": "economic_sector",
    "Codi NACE": "code_NACE",
    "Descripció NACE": "description_NACE",
    "Tipus Industrial o productiva": "industrial_productive_type",
    "Codi CCAE": "raise_CCAE",
    "Descripció CCAE": "description_CCAE",
    "Tipus comercial": "commercial_type",
    "Tipus EMA": "EMA_type",
    "Data de modificació": "modification_date",
    "Codi Ens": "code_ens",
    "Data llicència": "license_date",
    "Annex": "annex",
    "Data CI": "date_CI",
    "Conjunt de dades": "data_set",
    "Últim canvi": "last_change",
}


def ingest_establishments(raw: DataFrame, names: Mapping[str, str] = ESTABLISHMENT_HEADINGS) -> DataFrame:
    """Rename scraped headings and drop rows without name, location or address."""
    return drop_incomplete(rename(raw, dict(names)), ["commercial_name", "location", "full_address"])


def supermarkets_among(establishments: DataFrame, word: str = "supermercat") -> DataFrame:
    """Distinct establishments whose activity names a supermarket."""
    chosen = establishments.where(F.contains(F.lower("activity_description"), F.lit(word)))
    return drop_incomplete(chosen.select("id", "commercial_name").dropDuplicates())


def store_list(establishments: DataFrame) -> DataFrame:
    """Distinct stores without missing fields."""
    return drop_incomplete(establishments.select("store_id", "store_name").dropDuplicates())


def store_inventory(baskets: DataFrame, products: DataFrame) -> DataFrame:
    """One row per (store, product) from stores that list their product ids."""
    lines = baskets.select("store_id", "store_name", F.explode("product_ids").alias("product_id"))
    return lines.join(products, "product_id").select(
        "store_id", "store_name", "product_id", "product_name", "product_price"
    )


def customer_profile(customers: DataFrame, link: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers with their location, in customer order."""
    joined = customers.join(link, "customer_id").join(locations.drop("accuracy"), "location_id")
    return joined.orderBy("customer_id", "location_id")
