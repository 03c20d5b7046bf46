"""Product catalogue, shelf life and expected expiry."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog import inputs as i
from larder.catalog.inputs import table
from larder.functions.similarity import match_score, shared_tokens
from larder.operators.filters import excluding
from larder.operators.fuzzy import best_match
from larder.plans import catalogue, expiry
from larder.plans.browse import browse_expiry, browse_perishability, day_limits, expiry_view, perishability_view, pick_list
from larder.session import materialize, scratch_path

SEEN_ON = "1998-06-01"
NOTICE_DAY = "1998-06-01"


# --- inputs -------------------------------------------------------------------------


def british(s, d):
    p, size = F.col("p_retailprice"), F.col("p_size") % 5
    text = (
        F.when(size == 0, F.concat(F.lit("£"), F.format_number(p, 2)))
        .when(size == 1, F.format_string("%dp", F.col("p_size")))
        .when(size == 2, F.concat(F.lit("3 for £"), F.format_number(p, 2)))
        .when(size == 3, F.format_string("2 for %dp", F.col("p_size")))
        .otherwise("call us")
    )
    return table(s, d, "part").select(
        F.concat("p_name", F.lit(" "), "p_brand").alias("Product_name"), text.alias("Price"),
        F.col("p_type").alias("Product_Description"),
    )


def indian(s, d):
    odd = F.col("p_size") % 2 == 1
    return table(s, d, "part").select(
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 10 == 0, "no selling price").otherwise(F.format_number("p_retailprice", 2)).alias("selling_price"),
        F.when(odd, F.array("p_brand", "p_type")).alias("specifications"),
    )


def food(s, d):
    category = (
        F.when(F.col("p_type") == "ECONOMY", "Baby Care").when(F.col("p_type") == "SMALL", "Beauty & Hygiene")
        .when(F.col("p_type") != "PROMO", F.col("p_type"))
    )
    return table(s, d, "part").select(
        F.col("p_name").alias("product"), category.alias("category"),
        F.col("p_retailprice").alias("sale_price"), F.col("p_brand").alias("description"),
    )


def dated_products(s, d):
    """Lines as packages with a manufacture and an expiry text; line 7 has no expiry."""
    made = F.col("l_shipdate").cast("date")
    lines = table(s, d, "lineitem").join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        F.array("p_type", "p_brand", F.replace("p_name", F.lit(" "), F.lit("-"))).alias("prod_heirarachy"),
        F.date_format(made, "d MMM yyyy").alias("manufacturing_date"),
        F.when(F.col("l_linenumber") == 7, "").otherwise(
            F.date_format(F.date_add(made, F.col("p_size") + F.col("l_linenumber")), "d MMM yyyy")).alias("expiry_date"),
    )


def kept_products(s, d):
    """Shelf-life text per storage place, with alternatives and gaps."""
    n = F.col("p_size")
    return table(s, d, "part").select(
        F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") lasts for")).alias("item_description"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"),
        F.when(n % 4 == 0, "Opened/Unopened").when(n % 4 == 1, "Fresh or Cooked").when(n % 4 == 2, "Sealed!")
        .otherwise("plain").alias("type"),
        F.format_string("%d-%d Days", n % 5 + 1, n % 5 + 3).alias("pantry/fridge"),
        F.when(n % 3 == 0, "-").when(n % 3 == 1, "--").otherwise("2 Weeks").alias("counter - beyond printed date"),
        F.when(n % 11 != 0, F.format_string("%d+ Months", n % 7 + 1)).alias("Freezer"),
        F.when(n % 13 == 0, "12 Hours").otherwise("see label").alias("cool box"),
    )


def marked_products(s, d):
    lines = table(s, d, "lineitem").join(table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    best = F.date_add(F.col("l_shipdate").cast("date"), F.col("p_size"))
    return lines.select(
        F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" (200 g)")))
        .when(F.col("p_size") % 3 == 1, F.concat("p_name", F.lit(" 500 g"))).otherwise(F.col("p_name")).alias("Product_name"),
        F.date_format(best, "d MMM yyyy").alias("Expiry_Date"), F.lit(SEEN_ON).alias("seen_on"),
    )


def shelf_dates(s, d):
    return catalogue.shelf_life_from_dates(dated_products(s, d))


def shelf_text(s, d):
    return catalogue.shelf_life_from_text(kept_products(s, d))


def shelf_best_before(s, d):
    return catalogue.shelf_life_from_best_before(marked_products(s, d), "seen_on")


def perishability(s, d):
    return catalogue.perishability([shelf_dates(s, d), shelf_text(s, d), shelf_best_before(s, d)])


def spelled_purchases(s, d):
    """Purchases whose product names are spelled differently from the catalogue."""
    size = F.col("p_size") % 3
    name = (
        F.when(size == 0, F.concat("p_name", F.lit("s"))).when(size == 1, F.replace("p_name", F.lit("l"), F.lit("")))
        .otherwise(F.col("p_name"))
    )
    lines = table(s, d, "lineitem").join(table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    parts = table(s, d, "part").select("p_partkey", "p_retailprice", name.alias("product_name"))
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.format_string("%d-%d", "l_orderkey", "l_linenumber").alias("id"),
        F.col("o_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), "product_name",
        F.col("p_retailprice").alias("unit_price"), F.col("l_quantity").cast("int").alias("quantity"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("purchase_date"),
    )


def names_catalogue(s, d):
    """Shelf life per product name: three weeks for size 1, and so on."""
    return table(s, d, "part").groupBy(F.col("p_name").alias("product_name")).agg(
        (F.min("p_size") * 21).alias("avg_expiry_days")
    )


def expected(s, d, method="levenshtein"):
    return expiry.expected_expiry(spelled_purchases(s, d), i.customers(s, d), names_catalogue(s, d), method)


def matched(s, d, method):
    bought = spelled_purchases(s, d).select(F.col("product_name").alias("product")).distinct()
    return best_match(names_catalogue(s, d), bought, "product_name", "product", method)


def match_scores(s, d):
    """How alike a product's name is to one put together from its own words, 0 below 60."""
    other = F.concat(F.element_at(F.split("p_name", " "), -1), F.lit(" "), F.lower("p_type"))
    return table(s, d, "part").select("p_partkey", match_score(F.col("p_name"), other, "ratio", 60).alias("score"))


def notices(s, d):
    lines = expiry.notices(expected(s, d), NOTICE_DAY)
    return lines.select(
        "email_id", "customer_name", "part", "n_items", F.array_join("product_name", ", ").alias("products"),
        F.array_join(F.transform("expected_expiry_date", lambda x: x.cast("string")), ", ").alias("dates"), "html",
    )


def _mailbox():
    """A sender that turns down every notice of a number of lines that four divides."""
    def send(notice):
        if notice.n_items % 4 == 0:
            raise ConnectionError("mailbox is full")

    return send


def delivery(s, d):
    """All notices delivered twice over one ledger: states and, to show that none went twice, outcomes."""
    lines, ledger = materialize(expiry.notices(expected(s, d), NOTICE_DAY), "all-notices"), scratch_path(s, "ledger")
    outcomes = [expiry.deliver(lines, _mailbox, ledger) for _ in range(2)]
    n = outcomes[0].unionByName(outcomes[1]).groupBy("notice").agg(F.count("*").alias("n"))
    return expiry.ledger_state(s, ledger).join(n, "notice", "left").groupBy("status").agg(
        F.count("*").alias("n_notices"), F.sum("n").alias("n_outcomes"))


def perishability_page(s, d):
    view = perishability_view(perishability(s, d))
    return browse_perishability(view, {"category": "PROMO", "product_name": "ring"}, (2, 30))


QUERIES = {
    "catalogue_union": lambda s, d: catalogue.all_products(british(s, d), indian(s, d), food(s, d)),
    "catalogue_ids_unique": lambda s, d: catalogue.all_products(british(s, d), indian(s, d), food(s, d)).agg(
        F.count("*").alias("n_rows"), F.countDistinct("product_id").alias("n_ids")),
    "price_text_parse": lambda s, d: catalogue.british_products(british(s, d)).select("product_name", "price", "product_description"),
    "exclude_categories": lambda s, d: excluding(food(s, d), "category", catalogue.NON_FOOD),
    "shelf_life_dates": shelf_dates,
    "shelf_life_rows": lambda s, d: catalogue.shelf_life_rows(kept_products(s, d)),
    "shelf_life_text": shelf_text,
    "best_before": shelf_best_before,
    "perishability_catalogue": perishability,
    "fuzzy_match": lambda s, d: matched(s, d, "levenshtein"),
    "fuzzy_match_partial": lambda s, d: matched(s, d, "partial_token_sort_ratio"),
    "fuzzy_match_ratio": lambda s, d: matched(s, d, "ratio"),
    "fuzzy_match_token_set": lambda s, d: matched(s, d, "partial_token_set_ratio"),
    "match_score": match_scores,
    "token_overlap": lambda s, d: table(s, d, "part").select(
        "p_partkey", shared_tokens(F.col("p_name"), F.concat(F.lit("small red "), F.lower("p_type"), F.lit(" ring"))).alias("shared")),
    "expected_expiry": expected,
    "expected_expiry_partial": lambda s, d: expected(s, d, "partial_token_sort_ratio"),
    "expiry_notifications": notices,
    "expiry_delivery": delivery,
    "perishability_browser": perishability_page,
    "perishability_limits": lambda s, d: day_limits(perishability_view(perishability(s, d))),
    "sorted_distinct": lambda s, d: pick_list(perishability_view(perishability(s, d)), "sub_category", {"category": "Promo"}),
    "expiry_browser": lambda s, d: browse_expiry(
        expiry_view(expected(s, d)), {"product_name": "RING", "customer_name": None},
        ("1996-01-01", "1997-12-31"), ("1996-06-01", "1999-12-31")),
}

# Half-up on the printed digits, as Spark rounds a double.
_R2 = "CAST(round(CAST(CAST({} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"

BRITISH = f"""
    SELECT p_name || ' ' || p_brand AS product_name, p_type AS product_description,
           {_R2.format('''CASE p_size % 5 WHEN 0 THEN p_retailprice * 1.16 WHEN 1 THEN p_size / 100.0 * 1.16
                              WHEN 2 THEN p_retailprice / 3 * 1.16 WHEN 3 THEN p_size / 100.0 / 2 * 1.16 ELSE 0 END''')} AS price
    FROM part"""
CATALOGUE = f"""
    SELECT * FROM ({BRITISH})
    UNION ALL BY NAME
    SELECT p_name AS product_name,
           CASE WHEN p_size % 10 = 0 THEN 0.0 ELSE {_R2.format('p_retailprice * 0.011')} END AS price,
           CASE WHEN p_size % 2 = 1 THEN ' ' || p_brand || ' ' || p_type ELSE 'no description available' END AS product_description
    FROM part
    UNION ALL BY NAME
    SELECT p_name AS product_name, {_R2.format('p_retailprice * 0.011')} AS price, p_brand AS product_description
    FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'PROMO')"""

SHELF_DATES = """
    SELECT lower(p_type) AS category, lower(replace(p_brand, '-', ' ')) AS sub_category, p_name AS product_name,
           CAST(min(CASE WHEN l_linenumber < 7 THEN p_size + l_linenumber END) AS INTEGER) AS avg_expiry_days,
           'Flipkart' AS source
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""
SHELF_ROWS = """
    SELECT lower(p_type) AS category, lower(p_brand) AS sub_category, p_name AS product_name, type, kept_place, days
    FROM part
    JOIN (VALUES (0,'opened'),(0,'unopened'),(1,'unspecified'),(1,'cooked'),(2,'unopened'),(3,'unspecified')) t(r, type) ON p_size % 4 = r
    JOIN (SELECT k, place FROM (VALUES (1,'pantry'),(1,'fridge'),(2,'counter'),(3,'Freezer'),(4,'cool box')) v(k, place)) v(k, kept_place) ON true
    CROSS JOIN LATERAL (SELECT CAST(CASE k WHEN 1 THEN p_size % 5 + 1 WHEN 2 THEN CASE WHEN p_size % 3 = 2 THEN 14 END
        WHEN 3 THEN CASE WHEN p_size % 11 <> 0 THEN (p_size % 7 + 1) * 30 END
        WHEN 4 THEN CASE WHEN p_size % 13 = 0 THEN 1 END END AS INTEGER) AS days)
    WHERE days IS NOT NULL"""
SHELF_TEXT = f"""
    SELECT category, sub_category, product_name, min(days) AS avg_expiry_days, 'Eat by Date' AS source
    FROM ({SHELF_ROWS}) GROUP BY ALL"""
BEST_BEFORE = f"""
    SELECT ' ' AS category, ' ' AS sub_category,
           p_name || CASE WHEN p_size % 3 < 2 THEN ' ' ELSE '' END AS product_name,
           CAST(min(CAST(l_shipdate AS DATE) + p_size - DATE '{SEEN_ON}') AS INTEGER) AS avg_expiry_days,
           'Approved Food' AS source
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE CAST(l_shipdate AS DATE) + p_size > DATE '{SEEN_ON}' GROUP BY ALL"""
PERISHABILITY = f"""
    SELECT category, sub_category, trim(product_name) AS product_name, avg_expiry_days, source
    FROM ({SHELF_DATES} UNION ALL {SHELF_TEXT} UNION ALL {BEST_BEFORE})
    QUALIFY rank() OVER (PARTITION BY category, sub_category, trim(product_name) ORDER BY avg_expiry_days NULLS FIRST) = 1"""
PER_VIEW = f"""
    SELECT upper(left(category, 1)) || lower(substr(category, 2)) AS category,
           upper(left(sub_category, 1)) || lower(substr(sub_category, 2)) AS sub_category,
           list_aggregate(list_transform(string_split(product_name, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), 'string_agg', ' ') AS product_name,
           avg_expiry_days
    FROM ({PERISHABILITY}) WHERE source = 'Flipkart' AND avg_expiry_days IS NOT NULL"""

SPELLED = """CASE p_size % 3 WHEN 0 THEN p_name || 's' WHEN 1 THEN replace(p_name, 'l', '') ELSE p_name END"""
MATCH = f"""
    SELECT product_name, product, score FROM (
        SELECT product_name, product,
               CAST(round(100 * (1 - levenshtein(product_name, product) / CAST(greatest(length(product_name), length(product)) AS DOUBLE))) AS INTEGER) AS score
        FROM (SELECT DISTINCT p_name AS product_name FROM part), (
            SELECT DISTINCT {SPELLED} AS product FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)))
    WHERE score >= 80 QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY score DESC, product) = 1"""


def _sorted_words(text: str, distinct: bool = False) -> str:
    words = f"list_sort(string_split(lower({text}), ' '))"
    return f"array_to_string({f'list_sort(list_distinct({words}))' if distinct else words}, ' ')"


def _lcs(pairs: str) -> str:
    """Common table expressions ending in ``lcs_of`` (a, b, n): longest common subsequences of the pairs a, b.

    ``vals`` is the row of the usual table for the first i letters of a; each step makes the next row, whose
    cells are running maxima.
    """
    return f"""
        lcs(a, b, i, vals) AS (
            SELECT a, b, 0, list_transform(range(length(b)), lambda x: 0) FROM ({pairs})
            UNION ALL
            SELECT a, b, i + 1, list_transform(range(1, length(b) + 1), lambda j: CAST(list_max(cells[1:j]) AS INTEGER))
            FROM (SELECT a, b, i, list_transform(range(1, length(b) + 1), lambda j:
                      CASE WHEN substr(b, j, 1) = substr(a, i + 1, 1) THEN coalesce(vals[j - 1], 0) + 1 ELSE vals[j] END) AS cells
                  FROM lcs WHERE i < length(a))),
        lcs_of AS (SELECT a, b, vals[-1] AS n FROM lcs WHERE i = length(a))"""


def _match_sql(method: str) -> str:
    """All pairs of names scored by one of the subsequence methods, the best right name per left name kept."""
    form = {"ratio": "{}", "partial_token_sort_ratio": _sorted_words("{}"), "partial_token_set_ratio": _sorted_words("{}", True)}[method]
    whole = method == "ratio"
    cut = ("SELECT l, r, l AS a, r AS b FROM texts" if whole else """
        SELECT l, r, short AS a, substr(long, CAST(i AS INTEGER) + 1, length(short)) AS b
        FROM (SELECT l, r, CASE WHEN length(l) <= length(r) THEN l ELSE r END AS short,
                     CASE WHEN length(l) <= length(r) THEN r ELSE l END AS long FROM texts), unnest(range(length(long) - length(short) + 1)) u(i)""")
    score = "max(round_even(200.0 * n / (length(a) + length(b)), 0))"
    if method == "partial_token_set_ratio":
        score = f"CASE WHEN len(list_intersect(string_split(l, ' '), string_split(r, ' '))) > 0 THEN 100 ELSE {score} END"
    return f"""
    WITH RECURSIVE names AS (
        SELECT product_name, product, {form.format('product_name')} AS l, {form.format('product')} AS r
        FROM (SELECT DISTINCT p_name AS product_name FROM part), (
            SELECT DISTINCT {SPELLED} AS product FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem))),
    texts AS (SELECT DISTINCT l, r FROM names),
    cuts AS ({cut}),
    {_lcs('SELECT DISTINCT a, b FROM cuts')},
    scores AS (SELECT l, r, CAST({score} AS INTEGER) AS score FROM cuts JOIN lcs_of USING (a, b) GROUP BY l, r)
    SELECT product_name, product, score FROM names JOIN scores USING (l, r) WHERE score >= 80
    QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY score DESC, product) = 1"""


def _expected_sql(match: str) -> str:
    return f"""
    SELECT l_orderkey || '-' || l_linenumber AS id, c_custkey AS customer_id, c_name AS customer_name,
           'c' || c_custkey || '@example.com' AS email_id, {SPELLED} AS product_name, p_retailprice AS unit_price,
           CAST(l_quantity AS INTEGER) AS quantity, strftime(o_orderdate, '%Y-%m-%d') AS purchase_date,
           CAST(days AS INTEGER) AS avg_expiry_days,
           CAST(o_orderdate AS DATE) + CAST(ceil(days / 2) AS INTEGER) AS expected_expiry_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey
    JOIN ({match}) m ON m.product = {SPELLED}
    JOIN (SELECT p_name AS product_name, min(p_size) * 21 AS days FROM part GROUP BY 1) k ON k.product_name = m.product_name"""


EXPECTED = _expected_sql(MATCH)

ORACLES = {
    "catalogue_union": f"""
        SELECT row_number() OVER (ORDER BY product_name NULLS FIRST, price NULLS FIRST, product_description NULLS FIRST) AS product_id,
               product_name, price, product_description
        FROM ({CATALOGUE})""",
    "catalogue_ids_unique": f"SELECT count(*) AS n_rows, count(*) AS n_ids FROM ({CATALOGUE})",
    "price_text_parse": f"SELECT product_name, price, product_description FROM ({BRITISH})",
    "exclude_categories": """
        SELECT p_name AS product, p_type AS category, p_retailprice AS sale_price, p_brand AS description
        FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'PROMO')""",
    "shelf_life_dates": SHELF_DATES,
    "shelf_life_rows": SHELF_ROWS,
    "shelf_life_text": SHELF_TEXT,
    "best_before": BEST_BEFORE,
    "perishability_catalogue": PERISHABILITY,
    "fuzzy_match": MATCH,
    "fuzzy_match_partial": _match_sql("partial_token_sort_ratio"),
    "fuzzy_match_ratio": _match_sql("ratio"),
    "fuzzy_match_token_set": _match_sql("partial_token_set_ratio"),
    "match_score": f"""
        WITH RECURSIVE texts AS (SELECT p_partkey, p_name AS a, string_split(p_name, ' ')[-1] || ' ' || lower(p_type) AS b FROM part),
        {_lcs('SELECT DISTINCT a, b FROM texts')}
        SELECT p_partkey, CASE WHEN score >= 60 THEN score ELSE 0 END AS score
        FROM (SELECT p_partkey, CAST(round_even(200.0 * n / (length(a) + length(b)), 0) AS INTEGER) AS score FROM texts JOIN lcs_of USING (a, b))""",
    "expected_expiry_partial": _expected_sql(_match_sql("partial_token_sort_ratio")),
    "token_overlap": """
        SELECT p_partkey, CAST(len(list_intersect(string_split(p_name, ' '), ['small', 'red', lower(p_type), 'ring'])) AS INTEGER) AS shared FROM part""",
    "expected_expiry": EXPECTED,
    "expiry_delivery": f"""
        SELECT status, count(*) AS n_notices, count(*) AS n_outcomes
        FROM (SELECT CASE WHEN count(*) % 4 = 0 THEN 'open' ELSE 'sent' END AS status FROM ({EXPECTED})
              WHERE expected_expiry_date - DATE '{NOTICE_DAY}' BETWEEN 1 AND 19 GROUP BY email_id, customer_name)
        GROUP BY status""",
    "expiry_notifications": f"""
        SELECT email_id, customer_name, 0 AS part, CAST(count(*) AS INTEGER) AS n_items,
               string_agg(product_name, ', ' ORDER BY expected_expiry_date, product_name) AS products,
               string_agg(CAST(expected_expiry_date AS VARCHAR), ', ' ORDER BY expected_expiry_date, product_name) AS dates,
               '<p>Dear ' || customer_name || ',</p><table>' || string_agg('<tr><td>' || product_name || '</td><td>' ||
                   expected_expiry_date || '</td></tr>', '' ORDER BY expected_expiry_date, product_name) || '</table>' AS html
        FROM ({EXPECTED})
        WHERE expected_expiry_date - DATE '{NOTICE_DAY}' BETWEEN 1 AND 19 GROUP BY email_id, customer_name""",
    "perishability_browser": f"""
        SELECT * FROM ({PER_VIEW}) WHERE category ILIKE '%promo%' AND product_name ILIKE '%ring%' AND avg_expiry_days BETWEEN 2 AND 30""",
    "perishability_limits": f"SELECT min(avg_expiry_days) AS lowest, max(avg_expiry_days) AS highest FROM ({PER_VIEW})",
    "sorted_distinct": f"SELECT DISTINCT sub_category FROM ({PER_VIEW}) WHERE category = 'Promo'",
    "expiry_browser": f"""
        SELECT customer_name,
               list_aggregate(list_transform(string_split(product_name, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), 'string_agg', ' ') AS product_name,
               purchase_date, CAST(expected_expiry_date AS VARCHAR) AS expected_expiry_date
        FROM ({EXPECTED})
        WHERE expected_expiry_date >= CAST(purchase_date AS DATE) + 10 AND product_name ILIKE '%ring%'
          AND purchase_date BETWEEN '1996-01-01' AND '1997-12-31'
          AND expected_expiry_date BETWEEN DATE '1996-06-01' AND DATE '1999-12-31'""",
}
