"""Recipes, receipts, invoices, pages and shop links."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.inputs import table
from larder.functions.money import pair_spec_lines, rupee_block
from larder.plans import extraction
from larder.plans.recipes import find_indexed, find_recipes, index_recipes, prepare_recipes
from larder.plans.reviews import apply_sentiment, fit_sentiment
from larder.session import scratch_path


def meals(s, d):
    amount = F.col("p_size").cast("string")
    return table(s, d, "part").select(
        "p_partkey", F.col("p_name").alias("food_name"), F.col("p_type").alias("description"),
        F.array(
            F.concat(amount, F.lit("g flour")), F.concat(amount, F.lit(" litres "), "p_name"),
            F.lit("½ lemon to serve"), F.lit("Handful nuts - "),
        ).alias("ingredients"),
    )


def document_recipes(s, d):
    return table(s, d, "documents").select(
        F.col("doc_id").cast("string").alias("food_name"), F.col("text").alias("clean_ingredients"),
        F.col("lang").alias("description"),
    )


def indexed_search(s, d):
    folder = scratch_path(s, "recipes")
    index_recipes(document_recipes(s, d), folder)
    return find_indexed(s, folder, ["UND ", "es.", "(a)"]).select("food_name", "description", F.md5("clean_ingredients").alias("digest"))


def _goods():
    return F.regexp_replace("o_orderpriority", r"^\d-", "")


def receipts(s, d):
    """One receipt per order: an item with amount and total, one without, and the total line."""
    price = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))
    text = F.concat(
        F.lit("ticket "), "o_orderkey", F.lit("\nSUPER "), "o_orderstatus", F.lit("A, .\n"),
        F.lit("Calle mayor "), F.col("o_custkey"), F.lit("\n"),
        F.col("o_orderkey") % 9 + 1, F.lit(" "), _goods(), F.lit(" "), price, F.lit(" "), price, F.lit("\n"),
        F.lit("PA% INTEGRAL+ 1,25\n"), F.lit("TOTAL "), price, F.lit("\n"),
    )
    return table(s, d, "orders").select("o_orderkey", text.alias("text"))


def answers(s, d):
    """Model answers: prose around the invoice, and some without any invoice."""
    total = F.format_string("%.2f", "o_totalprice")
    body = F.concat(
        F.lit('Here it is:\n{"Invoice no.": "'), "o_orderkey", F.lit('", "location": "STREET '), "o_custkey",
        F.lit('", "supermarket_name": "SUPER", "Date": "'), F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.lit('", "products": [{"name": "'), _goods(), F.lit('", "Unit price": "'), total,
        F.lit('", "quantity": "1", "amount": "'), total,
        F.lit('"}, {"name": "PA D\'ORDI", "Unit price": "1,25", "quantity": "2", "amount": "2,50"}], "total_price": "'), total,
        F.lit('", "total_products": "3", "mode_of_payment": "CARD"}\nAnything else?'),
    )
    return table(s, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", body).otherwise("No invoice in this picture.").alias("answer")
    )


def shop_links(s, d):
    section = F.element_at(
        F.array(*[F.lit(x) for x in ("staples", "home-kitchen", "snacks", "household-care", "dairy")]), F.col("p_size") % 5 + 1)
    last = F.when(F.col("p_size") % 7 == 0, "pr?sid=eat").otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    return table(s, d, "part").select(
        "p_partkey", F.concat_ws("/", F.lit("https://shop.example/grocery"), section, F.lower("p_type"), last).alias("url"))


def page_summary(s, d):
    return extraction.page_fields(table(s, d, "pages"), "page_id").select(
        "page_id", "name", F.array_join("links", " ").alias("links"), F.array_join("entries", "|").alias("entries"),
        F.md5("description").alias("description_digest"))


def page_tables(s, d):
    """Nation pages with a table of their key and region, parsed back into records."""
    html = F.concat(
        F.lit("<html><table class='x'><tr><th>Name</th><th> Keeps <b>for</b></th></tr><tr><td>"), "p_name",
        F.lit("</td><td>"), F.col("p_size"), F.lit(" Days &amp; more</td></tr><tr><td>"), "p_brand", F.lit("</td><td>-</td></tr></table></html>"))
    return extraction.table_records(table(s, d, "part").select("p_partkey", html.alias("html")), "p_partkey")


def price_blocks(s, d):
    text = F.concat(
        F.lit("₹"), F.format_number("p_retailprice", 2), F.when(F.col("p_size") % 3 != 0, F.concat(
            F.lit("₹"), F.format_number(F.col("p_retailprice") + (F.col("p_size") - 25) * 10, 2), F.lit("12% off"))).otherwise(""))
    return table(s, d, "part").select("p_partkey", rupee_block(text).alias("b")).select("p_partkey", "b.*")


def spec_pairs(s, d):
    blocks = F.array(
        F.concat(F.lit("Brand\n"), "p_brand", F.lit("\nType\n"), "p_type"),
        F.concat(F.lit("Size\n"), F.col("p_size"), F.lit("\nEnd")), F.lit("unused\nblock"))
    return table(s, d, "part").select("p_partkey", F.array_join(pair_spec_lines(blocks), "|").alias("specs"))


def sentiment_model(s, d):
    docs, labels = table(s, d, "documents"), table(s, d, "labels")
    labelled = docs.join(labels, "doc_id").select("text", F.col("quality").cast("double").alias("label"))
    model = fit_sentiment(labelled, "text", "label")
    return apply_sentiment(model, docs.select("doc_id", "text")).select("doc_id", "sentiment_label", F.round("sentiment_score", 6).alias("sentiment_score"))


QUERIES = {
    "recipe_clean": lambda s, d: prepare_recipes(meals(s, d)),
    "recipe_clean_compat": lambda s, d: prepare_recipes(meals(s, d), compat=True).select("p_partkey", "clean_ingredients"),
    "recipe_search": lambda s, d: find_recipes(document_recipes(s, d), ["UND ", "es.", "(a)"]).select(
        "food_name", "description", F.md5("clean_ingredients").alias("digest")),
    "recipe_search_indexed": indexed_search,
    "receipt_header": lambda s, d: extraction.parse_receipts(receipts(s, d)).select("o_orderkey", "store_name", "store_address"),
    "receipt_items": lambda s, d: extraction.receipt_items(extraction.parse_receipts(receipts(s, d)), ["o_orderkey"]),
    "invoice_header": lambda s, d: extraction.parse_invoices(answers(s, d)).drop("products"),
    "invoice_products": lambda s, d: extraction.invoice_products(extraction.parse_invoices(answers(s, d)), ["o_orderkey", "invoice_no"]),
    "page_fields": page_summary,
    "page_table_records": page_tables,
    "price_split": price_blocks,
    "url_hierarchy": lambda s, d: extraction.link_hierarchy(shop_links(s, d)),
    "url_filter": lambda s, d: extraction.grocery_links(shop_links(s, d)),
    "spec_pairs": spec_pairs,
    "sentiment_model": sentiment_model,
}

_GOODS = "substr(o_orderpriority, 3)"
_SECTION = "list_extract(['staples','home-kitchen','snacks','household-care','dairy'], p_size % 5 + 1)"
_LAST = "CASE WHEN p_size % 7 = 0 THEN 'pr?sid=eat' ELSE replace(p_name, ' ', '-') END"
_LINKS = f"""
    SELECT p_partkey, 'https://shop.example/grocery/' || category || '/' || sub_category || '/' || product_group AS url,
           category, sub_category, product_group
    FROM (SELECT p_partkey, {_SECTION} AS category, lower(p_type) AS sub_category, {_LAST} AS product_group FROM part)"""


def _tagless(x: str) -> str:
    plain = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        plain = f"replace({plain}, '{a}', '{b}')"
    return f"trim(regexp_replace({plain}, '\\s+', ' ', 'g'))"


def _found(tag: str) -> str:
    return f"regexp_extract_all(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1)"


ORACLES = {
    "recipe_clean": """
        SELECT p_partkey, p_name AS food_name, p_type AS description, 'flour, litres ' || p_name || ', lemon , nuts' AS clean_ingredients,
               p_size || 'g flour, ' || p_size || ' litres ' || p_name || ', ½ lemon to serve, handful nuts - ' AS ingredients_lower FROM part""",
    "recipe_clean_compat": "SELECT p_partkey, 'flour, itres ' || p_name || ', lemon , nuts' AS clean_ingredients FROM part",
    "recipe_search": """
        SELECT CAST(doc_id AS VARCHAR) AS food_name, lang AS description, md5(text) AS digest FROM documents
        WHERE contains(lower(text), 'und ') OR contains(lower(text), 'es.') OR contains(lower(text), '(a)')""",
    "recipe_search_indexed": """
        SELECT CAST(doc_id AS VARCHAR) AS food_name, lang AS description, md5(text) AS digest FROM documents
        WHERE contains(lower(text), 'und ') OR contains(lower(text), 'es.') OR contains(lower(text), '(a)')""",
    "receipt_header": """
        SELECT o_orderkey, 'SUPER ' || o_orderstatus || 'A' AS store_name, 'Calle mayor ' || o_custkey AS store_address FROM orders""",
    "receipt_items": f"""
        SELECT o_orderkey, CAST(o_orderkey % 9 + 1 AS INTEGER) AS quantity, {_GOODS} AS description,
               o_totalprice AS unit_price, o_totalprice AS total_price FROM orders
        UNION ALL SELECT o_orderkey, 1, 'PA% INTEGRAL', 1.25, 1.25 FROM orders
        UNION ALL SELECT o_orderkey, 1, 'TOTAL', o_totalprice, o_totalprice FROM orders""",
    "invoice_header": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS invoice_no,
               CASE WHEN o_orderstatus <> 'P' THEN 'STREET ' || o_custkey END AS location,
               CASE WHEN o_orderstatus <> 'P' THEN 'SUPER' END AS supermarket_name,
               CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%d/%m/%Y') END AS date,
               CASE WHEN o_orderstatus <> 'P' THEN printf('%.2f', o_totalprice) END AS total_price,
               CASE WHEN o_orderstatus <> 'P' THEN '3' END AS total_products,
               CASE WHEN o_orderstatus <> 'P' THEN 'CARD' END AS mode_of_payment FROM orders""",
    "invoice_products": f"""
        SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS invoice_no,
               CASE {_GOODS} WHEN 'NOT SPECIFIED' THEN 'Not Specified' ELSE left({_GOODS}, 1) || lower(substr({_GOODS}, 2)) END AS product_name,
               printf('%.2f', o_totalprice) AS unit_price, '1' AS quantity, printf('%.2f', o_totalprice) AS amount
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT o_orderkey, CAST(o_orderkey AS VARCHAR), 'Pa D''Ordi', '1,25', '2', '2,50' FROM orders WHERE o_orderstatus <> 'P'""",
    "page_fields": f"""
        SELECT page_id, coalesce(nullif({_tagless("coalesce(list_extract(" + _found('h1') + ", 1), '')")}, ''), 'No name found') AS name,
               array_to_string(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"', 1), ' ') AS links,
               array_to_string(list_transform({_found('li')}, lambda x: {_tagless('x')}), '|') AS entries,
               md5(coalesce(nullif(trim(array_to_string(list_transform({_found('p')}, lambda x: {_tagless('x')}), ' ')), ''), 'No description found')) AS description_digest
        FROM pages""",
    "page_table_records": """
        SELECT p_partkey, 0 AS row_no, 'name' AS heading, p_name AS value FROM part
        UNION ALL SELECT p_partkey, 0, 'keeps for', p_size || ' Days & more' FROM part
        UNION ALL SELECT p_partkey, 1, 'name', p_brand FROM part
        UNION ALL SELECT p_partkey, 1, 'keeps for', '-' FROM part""",
    "price_split": """
        SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_retailprice ELSE least(p_retailprice, other) END AS selling_price,
               CASE WHEN p_size % 3 = 0 THEN p_retailprice ELSE greatest(p_retailprice, other) END AS actual_price,
               CASE WHEN p_size % 3 = 0 THEN '0' ELSE '12' END AS discount
        FROM (SELECT *, round(p_retailprice + (p_size - 25) * 10, 2) AS other FROM part)""",
    "url_hierarchy": _LINKS,
    "url_filter": f"SELECT * FROM ({_LINKS}) WHERE category NOT IN ('home-kitchen', 'household-care') AND product_group <> 'pr?sid=eat'",
    "spec_pairs": "SELECT p_partkey, 'Brand ' || p_brand || '|Type ' || p_type || '|Size ' || p_size || '|End' AS specs FROM part",
}
