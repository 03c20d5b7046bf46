"""Generic operators: order, sampling, first rows, profiles, keys, text helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.catalog.inputs import digest_sql, table
from larder.functions.text import blank_to_null, contains_ci, strip_hidden, title_words
from larder.operators.filters import within
from larder.operators.keys import content_key, dense_key
from larder.operators.ranking import first_per_key, lowest_with_ties, seeded_order, seeded_sample, seeded_shuffle, top_per_key
from larder.operators.shape import salted_join, split_rows, union_all, unpivot_others
from larder.operators.stats import profile


def shuffled(s, d):
    """The shuffled table with the order it is in, so that the order itself can be checked."""
    parts = table(s, d, "part").select("p_partkey", "p_name")
    return seeded_shuffle(parts, ["p_partkey"], 7).withColumn("place", seeded_order(["p_partkey"], 7))


def wide_to_tall(s, d):
    return unpivot_others(table(s, d, "part").select("p_partkey", "p_brand", "p_type", "p_size"), ["p_partkey"], "field", "content")


def pieces(s, d):
    joined = table(s, d, "part").select("p_partkey", F.concat("p_type", F.lit("/"), "p_name").alias("piece"))
    return split_rows(split_rows(joined, "piece", "/"), "piece", " ")


def profiled(s, d):
    return profile(table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left").drop("text"), "doc_id")


def hot_join(s, d):
    """Lines and suppliers joined per nation with every key treated as hot.

    Either side is made distinct before the join, with the number of its equal rows, so that every pair comes once and
    pairs need no shuffle to be told apart.
    """
    lines = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("nation"), "o_orderkey").groupBy("nation", "o_orderkey").agg(F.count("*").alias("n_lines"))
    stores = table(s, d, "supplier").groupBy(F.col("s_nationkey").alias("nation"), "s_suppkey").agg(F.count("*").alias("n_stores"))
    pair = F.col("o_orderkey").isNotNull() & F.col("s_suppkey").isNotNull()
    return salted_join(lines, stores, "nation", hot_rows=100).groupBy("nation").agg(
        F.sum(F.col("n_lines") * F.col("n_stores")).alias("n"), F.count_if(pair).alias("n_pairs"))


def text_helpers(s, d):
    c = F.concat(F.lit("​"), F.col("p_name"), F.lit("\t"))
    return table(s, d, "part").select(
        "p_partkey", strip_hidden(c).alias("printable"), title_words(F.concat("p_name", F.lit("'s "), "p_type")).alias("title"),
        blank_to_null(F.when(F.col("p_size") % 2 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_name"))).alias("filled"),
        contains_ci(F.col("p_name"), "RING").alias("is_ring"))


QUERIES = {
    "group_count": lambda s, d: table(s, d, "part").groupBy("p_type").agg(F.count("*").alias("n")),
    "global_min_max": lambda s, d: table(s, d, "lineitem").agg(
        F.min(F.col("l_shipdate").cast("date")).alias("first"), F.max(F.col("l_shipdate").cast("date")).alias("last")),
    "distinct_count": lambda s, d: table(s, d, "lineitem").agg(F.countDistinct("l_partkey").alias("n")),
    "first_per_key": lambda s, d: first_per_key(
        table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]),
    "top_per_key": lambda s, d: top_per_key(
        table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3),
    "lowest_with_ties": lambda s, d: lowest_with_ties(table(s, d, "part").select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size"),
    "seeded_shuffle": shuffled,
    "seeded_sample": lambda s, d: seeded_sample(table(s, d, "customer").select("c_custkey", "c_name"), ["c_custkey"], 50, 42),
    "top_k": lambda s, d: table(s, d, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5).select("o_orderkey", "o_totalprice"),
    "profile_nulls": profiled,
    "unpivot": wide_to_tall,
    "split_explode": pieces,
    "content_key": lambda s, d: table(s, d, "orders").select("o_orderkey", content_key("o_orderkey", "o_orderpriority").alias("row_key")),
    "dense_key": lambda s, d: dense_key(
        table(s, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"),
        ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"], "row_id"),
    "salted_join": hot_join,
    "range_filter": lambda s, d: within(table(s, d, "orders"), {"o_totalprice": (1000.0, 200000.0), "o_custkey": (10, None)}).groupBy("o_orderstatus").agg(F.count("*").alias("n")),
    "union_sources": lambda s, d: union_all([
        table(s, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
        table(s, d, "supplier").select(F.col("s_name").alias("name"), F.lit("store").alias("kind"))]),
    "text_helpers": text_helpers,
}

ORACLES = {
    "group_count": "SELECT p_type, count(*) AS n FROM part GROUP BY 1",
    "global_min_max": "SELECT CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem",
    "distinct_count": "SELECT count(DISTINCT l_partkey) AS n FROM lineitem",
    "first_per_key": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""",
    "top_per_key": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
    "lowest_with_ties": "SELECT p_partkey, p_brand, p_size FROM part QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY p_size) = 1",
    "seeded_shuffle": "SELECT p_partkey, p_name, md5(p_partkey || '-7') AS place FROM part",
    "seeded_sample": "SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey || '-42') LIMIT 50",
    "top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
    "profile_nulls": """
        SELECT count(*) AS n_rows, 6 AS n_columns, count(DISTINCT doc_id) AS n_keys,
               CAST(count(*) - count(doc_id) AS BIGINT) AS nulls_doc_id, CAST(count(*) - count(lang) AS BIGINT) AS nulls_lang,
               CAST(count(*) - count(source) AS BIGINT) AS nulls_source, CAST(count(*) - count(n_chars) AS BIGINT) AS nulls_n_chars,
               CAST(count(*) - count(quality) AS BIGINT) AS nulls_quality, CAST(count(*) - count(toxic) AS BIGINT) AS nulls_toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "unpivot": """
        SELECT p_partkey, 'p_brand' AS field, p_brand AS content FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
        UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part""",
    "split_explode": """
        SELECT p_partkey, p_type AS piece FROM part UNION ALL SELECT p_partkey, unnest(string_split(p_name, ' ')) FROM part""",
    "content_key": f"SELECT o_orderkey, {digest_sql('o_orderkey', 'o_orderpriority')} AS row_key FROM orders",
    "dense_key": """
        SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
               row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS row_id FROM lineitem""",
    "salted_join": """
        SELECT c_nationkey AS nation, count(*) AS n, count(*) AS n_pairs
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN supplier ON s_nationkey = c_nationkey GROUP BY 1""",
    "range_filter": """
        SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_custkey >= 10 GROUP BY 1""",
    "union_sources": """
        SELECT c_name AS name, c_acctbal AS balance, NULL AS kind FROM customer UNION ALL SELECT s_name, NULL, 'store' FROM supplier""",
    "text_helpers": """
        SELECT p_partkey, p_name AS printable,
               array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') || '''S '
                 || left(p_type, 1) || lower(substr(p_type, 2)) AS title,
               CASE WHEN p_size % 2 = 1 THEN p_name END AS filled, p_name LIKE '%ring%' AS is_ring FROM part""",
}
