"""Composed jobs on edge rows."""

import datetime
import re
import uuid
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.catalog import inputs, star as star_queries
from larder.functions.pricing import PricingRules
from larder.operators import calendar, keys
from larder.plans import browse, catalogue, cleaning, expiry, extraction, forecast, kpis, pricing, recipes, reviews, series, star
from larder.session import materialize

TS = "2024-06-01 00:00:00"


def day(text):
    return datetime.date.fromisoformat(text)


def test_establishment_headings(spark):
    assert len(cleaning.ESTABLISHMENT_HEADINGS) == 37
    raw = spark.createDataFrame([("1", "A", "1,2", "s"), ("2", None, "1,2", "s"), ("3", "C", None, "s")],
                                "Id string, `Nom comercial` string, `Localització` string, `Adreça completa` string")
    got = cleaning.ingest_establishments(raw)
    assert got.columns == ["id", "commercial_name", "location", "full_address"] and [r.id for r in got.collect()] == ["1"]


def test_cleaning(spark):
    people = spark.createDataFrame([(1, "Ann", "a@x"), (1, "Ann", "a@x"), (2, "Bo", "b@x")], "customer_id long, customer_name string, email_id string")
    assert cleaning.clean_customers(people).count() == 2
    places = spark.createDataFrame(
        [(1, 8001, 41.0, 2.0, 5), (2, 8002, None, 2.0, 5), (3, 8003, float("nan"), 1.0, 5), (1, 8001, 41.0, 2.0, 5)],
        "location_id long, postal_code long, latitude double, longitude double, accuracy int")
    assert [r.location_id for r in cleaning.clean_location(places).collect()] == [1, 1]
    shops = spark.createDataFrame(
        [("1", "A", "c", "s1", 1.0, 2.0, "41.5,2.25"), ("1", "A", "c", "s1", 1.0, 2.0, "41.5,2.25"),
         ("2", "B", "c", "s2", 1.0, 2.0, "41.5"), ("3", "C", "c", None, 1.0, 2.0, "1,2"), ("4", "D", "c", "s4", 1.0, 2.0, "x,y")],
        "id string, commercial_name string, county_code string, full_address string, UTMx double, UTMy double, location string")
    got = cleaning.clean_establishments(shops).collect()
    assert [(r.id, r.latitude, r.longitude) for r in got] == [("1", 41.5, 2.25)]


def purchases(spark):
    return spark.createDataFrame(
        [(1, "Ann", "milk", "1,234.50", 2, "2024-01-01"), (1, "Ann", "milk", "1,234.50", 2, "2024-01-01"),
         (1, "Ann", "bread", "2.00", 1, "2024-01-05"), (2, "Bo", "milk", "1.00", 3, "2024-02-10"),
         (3, "Cy", "rice", "1.00", 1, "2024-02-11")],
        "customer_id long, customer_name string, product_name string, unit_price string, quantity int, purchase_date string")


def star_tables(spark, numbered=False):
    bought = materialize(cleaning.clean_purchases(purchases(spark), numbered))
    people = spark.createDataFrame([(1, "Ann", "a@x"), (2, "Bo", "b@x")], "customer_id long, customer_name string, email_id string")
    link = spark.createDataFrame([(1, 10), (2, 10), (2, 99)], "customer_id long, location_id long")
    places = spark.createDataFrame(
        [(10, 8010, "b", 2.0, 1.0), (10, 8009, "c", 1.0, 5.0), (11, 8011, "d", 1.0, 1.0)],
        "location_id long, postal_code long, place_name string, latitude double, longitude double")
    return bought, people, link, places


def test_star_and_kpis(spark):
    bought, people, link, places = star_tables(spark, numbered=True)
    assert sorted(r.id for r in bought.collect()) == [0, 1, 2, 3]
    products = star.dim_product(bought, TS)
    assert [(r.product_id, r.product_name) for r in products.orderBy("product_id").collect()] == [(1, "bread"), (2, "milk"), (3, "rice")]
    dates = star.dim_date(bought, TS)
    assert dates.count() == 42 and dates.where("date_id = 20240229").count() == 0
    who = star.dim_customer(people, link, places, TS)
    assert {(r.customer_id, r.location_id) for r in who.collect()} == {(1, 10), (2, 10)}
    where = star.dim_customer_location(people, link, places, TS).collect()
    assert [tuple(r)[:5] for r in where] == [(10, 8009, "b", 1.0, 1.0)]
    fact = star.fact_customer_inventory(bought, products, who, TS)
    rows = fact.collect()
    # The customer without a dimension row is not in the fact; ids count from 1.
    assert len(rows) == 3 and {r.customer_id for r in rows} == {1, 2} and min(r.inventory_id for r in rows) == 1
    assert {r.unit_price for r in rows} == {"1234.50", "2.00", "1.00"}
    assert [tuple(r) for r in kpis.active_customers(fact, dates).collect()] == [(2024, 1, 1), (2024, 2, 1)]
    assert [tuple(r) for r in kpis.first_time_customers(fact, dates).collect()] == [(2024, 1, 1), (2024, 2, 1)]
    assert [tuple(r) for r in kpis.retention(fact, dates).collect()] == [(2024, 1, 1)]
    assert kpis.average_lifetime_value(fact).first()[0] == pytest.approx((2 * 1234.5 + 2 + 3) / 2)
    assert [tuple(r) for r in kpis.churn(fact, dates, "2024-03-01").collect()] == [(2024, 1, 1)]
    # A month before 31 March is 29 February.
    assert sum(r.churned_customers for r in kpis.churn(fact, dates, "2024-03-31").collect()) == 2


def test_store_dimension_shares_addresses(spark):
    shops = spark.createDataFrame(
        [("1", "A", "s", 1.0, 2.0, 41.5, 2.5), ("2", "B", "s", 1.0, 2.0, 41.5, 2.5), ("3", "C", "t", 1.0, 2.0, None, 2.5)],
        "id string, commercial_name string, full_address string, UTMx double, UTMy double, latitude float, longitude float")
    places = star.dim_store_location(shops, TS)
    assert sorted(r.location_id for r in places.collect()) == [7000, 7001]
    stores = {r.supermarket_id: r.location_id for r in star.dim_store(shops, places, TS).collect()}
    assert stores == {"1": 7000, "2": 7000, "3": 7001}


def test_store_sale_cleans_ids_and_needs_a_location(spark):
    bought, people, link, places = star_tables(spark)
    sales = spark.createDataFrame(
        [("​7\n", 1, "milk", "10", 1, "2024-01-01", "2 Jan 2024"), ("8", 1, "tofu", "10", 1, "2023-01-01", None), ("9", 1, "milk", "5", 1, "2024-01-01", None)],
        "store_id string, customer_id long, product_name string, unit_price string, quantity int, purchase_date string, expiry_date string")
    stores = spark.createDataFrame([(" 7", 7000), ("8", 7001), ("9", None)], "supermarket_id string, location_id long")
    got = star.fact_store_sale(
        sales, stores, star.dim_product(bought, TS), star.dim_date(bought, TS), star.dim_customer(people, link, places, TS), TS)
    assert {(r.store_id, r.location_id, r.product_id, r.purchase_date_id, r.dynamic_price) for r in got.collect()} == {
        ("7", 7000, 2, 20240101, 1.0), ("8", 7001, None, None, 10.0)}


def test_review_facts_keep_every_pair(spark):
    stock = spark.createDataFrame([("S", "1", p) for p in range(3)] + [("S", "2", 9), ("T", "3", 1)], "store_name string, store_id string, product_id int")
    notes = spark.createDataFrame([(1, "S", "great", 5, "2024-05-01"), (2, "S", "bad", 1, "2024-05-02")], "rid long, business_name string, text string, rating long, date string")
    scored = reviews.score_reviews(notes)
    rows = star.fact_store_review(stock, scored, TS, "rid").collect()
    assert len(rows) == 8 and len({r.review_id for r in rows}) == 8
    assert {(r.date_id, r.sentiment_label) for r in rows} == {("20240501", "positive"), ("20240502", "negative")}
    numbered = star.fact_store_review(stock, scored, TS, "rid", numbered=True).collect()
    assert sorted(r.review_id for r in numbered) == list(range(10000, 10008))


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_store_review_prepares_each_side_before_the_pairs(spark, tmp_path):
    tables = {
        "lineitem": ([(1, 5), (1, 5), (1, 6), (2, 5), (None, 5), (1, None), (2, 99), (9, 5)], "l_suppkey long, l_partkey long, l_extendedprice double, l_quantity double, l_shipdate timestamp"),
        "part": ([(5, "milk"), (5, "oats"), (6, None), (None, "tofu")], "p_partkey long, p_name string, p_size int"),
        "supplier": ([(1, "Supplier#000000000"), (1, "Supplier#000000000"), (1, "Supplier#000000001"), (2, "Supplier#000000000"), (2, None)], "s_suppkey long, s_name string"),
        "documents": ([(0, "the of the"), (0, "the of the"), (3, None), (12, "of")], "doc_id long, text string"),
        "labels": ([(0, 1, 0)], "doc_id long, quality int, toxic int"),
    }
    for name, (rows, schema) in tables.items():
        wide = [tuple(r) + (None,) * (schema.count(",") + 1 - len(r)) for r in rows]
        spark.createDataFrame(wide, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    goods = inputs.store_goods(spark, tmp_path)
    plainly = inputs.stock(spark, tmp_path).select("store_name", "store_id", "product_id").distinct()
    assert Counter(goods.collect()) == Counter(plainly.collect()) and goods.count() == 6
    assert goods.dtypes == plainly.dtypes

    fact = star_queries.fact_store_review(spark, tmp_path)
    scored = star_queries.scored_reviews(spark, tmp_path).select(
        F.col("business_name").alias("store_name"), F.round("sentiment_score", 6).alias("score"), "doc_id")
    pairs = plainly.join(scored, "store_name").select(keys.content_key("store_id", "product_id", "doc_id"), "store_id", "product_id", "score")
    assert Counter(map(tuple, pairs.collect())) == Counter(
        map(tuple, fact.select("review_id", "store_id", "product_id", "sentiment_score").collect()))
    # Scores are rounded and the texts of the digests made before the sides are joined, not once for every pair.
    assert "md5" in _optimized(fact) and "round(" not in _optimized(fact) and "length(" not in _optimized(fact)


def _find(node, name):
    """The nodes of a plan with this name, with the names of the nodes above each."""
    stack = [(node, ())]
    while stack:
        at, above = stack.pop()
        if at.nodeName().startswith(name):
            yield at, above
        children = at.children()
        stack += [(children.apply(k), (*above, at.nodeName())) for k in range(children.size())]


def test_review_texts_are_scored_before_ratings_are_joined(spark, tmp_path):
    documents = [(0, "the of the"), (0, "the of the"), (3, None), (12, "of"), (13, ""), (None, "by"), (14, "the")]
    labels = [(0, 1, 0), (12, 0, 1), (12, 1, 1), (None, 1, 0), (13, None, None), (14, 1, None), (99, 1, 0)]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got, plainly = star_queries.rounded_reviews(spark, tmp_path), star_queries.scored_reviews(spark, tmp_path)
    plainly = plainly.withColumn("sentiment_score", F.round("sentiment_score", 6))
    assert Counter(got.select(*plainly.columns).collect()) == Counter(plainly.collect()) and got.count() == 8
    # What a fact needs of the reviews holds no text, and none goes into the join.
    needed = got.select("business_name", "doc_id", "date", "sentiment_label", "sentiment_score")
    (join, _), = _find(needed._jdf.queryExecution().optimizedPlan(), "Join")
    assert {"text", "review"}.isdisjoint(re.findall(r"(\w+)#", join.children().apply(0).output().mkString(",")))


def test_goods_are_stored_without_a_value_twice(spark, monkeypatch):
    sides = []
    monkeypatch.setattr(star, "salted_join", lambda left, right, key: sides.append(left.columns) or left.join(right, key))
    stock = spark.createDataFrame([("S", None, 7), ("S", "1:n", None), ("S", "n", -3)], "store_name string, store_id string, product_id int")
    notes = spark.createDataFrame([(1, "S", "great", 5, "2024-05-01"), (None, "S", "bad", 1, "2024-05-02")], "rid long, business_name string, text string, rating long, date string")
    fact = star.fact_store_review(stock, reviews.score_reviews(notes), TS, "rid")
    plainly = stock.crossJoin(notes.select("rid")).select(keys.content_key("store_id", "product_id", "rid"), "store_id", "product_id")
    assert Counter(map(tuple, plainly.collect())) == Counter(map(tuple, fact.select("review_id", "store_id", "product_id").collect()))
    assert dict(fact.dtypes)["product_id"] == "int" and sides == [["store_name", "_store", "_product"]]


def test_reviews(spark):
    df = spark.createDataFrame([("GOOD", 3), ("Bad", 4), ("", None)], "text string, rating long")
    got = [(r.review, r.Sentiment, r.sentiment_label) for r in reviews.score_reviews(df).collect()]
    assert got == [("good", 0, "positive"), ("bad", 1, "negative"), ("", 1, "neutral")]
    other = reviews.score_reviews(df, scorer=lambda c: F.struct(F.lit("neutral").alias("label"), F.lit(0.1).alias("score")))
    assert {r.sentiment_score for r in other.collect()} == {0.1}


def test_shelf_life_text(spark):
    raw = spark.createDataFrame(
        [("Milk (whole) lasts for", "Dairy", "Milk", "Opened/Unopened", "3-4 Days", "2 Weeks", None),
         ("Rice", "Grains", "Rice", "Uncooked or Cooked", "1+ Years", "-", "text only"),
         ("Eggs", "Dairy", "Eggs", None, "5 Days", None, None)],
        "item_description string, category string, sub_category string, type string, `pantry/fridge` string, freezer string, `Counter - beyond printed date` string")
    rows = {tuple(r) for r in catalogue.shelf_life_rows(raw).collect()}
    assert rows == {
        ("dairy", "milk", "milk", s, p, 3) for s in ("opened", "unopened") for p in ("pantry", "fridge")
    } | {("dairy", "milk", "milk", s, "freezer", 14) for s in ("opened", "unopened")} | {
        ("grains", "rice", "rice", s, p, 365) for s in ("uncooked", "cooked") for p in ("pantry", "fridge")}
    best = {r.product_name: r.avg_expiry_days for r in catalogue.shelf_life_from_text(raw).collect()}
    assert best == {"milk": 3, "rice": 365}


def test_perishability_keeps_ties_between_sources(spark):
    cols = "category string, sub_category string, product_name string, avg_expiry_days int, source string"
    a = spark.createDataFrame([("c", "s", " soy  milk", 5, "A"), ("c", "s", "tea", 9, "A")], cols)
    b = spark.createDataFrame([("c", "s", "soy milk", 5, "B"), ("c", "s", "tea", 7, "B")], cols)
    got = {(r.product_name, r.avg_expiry_days, r.source) for r in catalogue.perishability([a, b]).collect()}
    assert got == {("soy milk", 5, "A"), ("soy milk", 5, "B"), ("tea", 7, "B")}


def test_best_before(spark):
    raw = spark.createDataFrame(
        [("Cola 6 x 330ml", "10 Jan 2024", "2024-01-01"), ("Cola", "5 Jan 2024", "2024-01-01"), ("Jam (200 g)", "1 Jan 2023", "2024-01-01"), ("Salt 500g", "bad", "2024-01-01")],
        "Product_name string, Expiry_Date string, seen string")
    got = {r.product_name: r.avg_expiry_days for r in catalogue.shelf_life_from_best_before(raw, "seen").collect()}
    assert got == {"Cola ": 9, "Cola": 4}


def test_catalogue_union(spark):
    british = spark.createDataFrame([("Jam", "£1.50", "red"), ("Tea", "??", "x")], "Product_name string, Price string, Product_Description string")
    indian = spark.createDataFrame([("Atta", "1,000", ["a", "b"]), ("Dal", "no selling price", None)], "name string, selling_price string, specifications array<string>")
    food = spark.createDataFrame([("Soap", "Beauty & Hygiene", 100.0, "d"), ("Rice", "Grains", 100.0, "d"), ("?", None, 1.0, "d")], "product string, category string, sale_price double, description string")
    got = {(r.product_name, r.price, r.product_description) for r in catalogue.all_products(british, indian, food).collect()}
    assert got == {("Jam", 1.74, "red"), ("Tea", 0.0, "x"), ("Atta", 11.0, " a b"), ("Dal", 0.0, "no description available"), ("Rice", 1.1, "d")}


def shelf(spark):
    return spark.createDataFrame([("small rings", 7), ("whole milk", 5), ("milk whole", 9), ("salt", 0)], "product_name string, avg_expiry_days int")


def test_expected_expiry(spark):
    bought = spark.createDataFrame(
        [("a", 1, "Ann", "small ring", 1.0, 1, "2024-01-01"), ("b", 1, "Ann", "milk", 1.0, 1, "2024-01-01"), ("c", 1, "Ann", "salt", 1.0, 1, "2024-01-01"), ("d", 9, "No", "milk", 1.0, 1, "2024-01-01")],
        "id string, customer_id long, customer_name string, product_name string, unit_price double, quantity int, purchase_date string")
    people = spark.createDataFrame([(1, "a@x")], "customer_id long, email_id string")
    got = sorted((r.id, r.avg_expiry_days, str(r.expected_expiry_date)) for r in expiry.expected_expiry(bought, people, shelf(spark)).collect())
    # Both milk entries pick the same purchase, so it appears twice; a life of zero days is dropped.
    assert got == [("a", 7, "2024-01-05"), ("b", 5, "2024-01-04"), ("b", 9, "2024-01-06")]


def test_notices_split_long_lists_without_losing_lines(spark):
    rows = [(str(i), "Ann", "a@x", f"p{i:03}", day("2024-01-10")) for i in range(95)] + [("z", "Bo", "b@x", "tea", day("2024-01-05")), ("y", "Bo", "b@x", "old", day("2024-01-01"))] + [(f"n{i}", "Cy", None, "salt", day("2024-01-09")) for i in range(50)]
    df = spark.createDataFrame(rows, "id string, customer_name string, email_id string, product_name string, expected_expiry_date date")
    got = expiry.notices(df, "2024-01-01", 20, lines_per_notice=20).collect()
    ann = [r for r in got if r.customer_name == "Ann"]
    assert len(ann) == 5 and sorted(p for r in ann for p in r.product_name) == [f"p{i:03}" for i in range(95)]
    assert all(r.product_name == sorted(r.product_name) and r.html.count("<tr>") == r.n_items for r in ann)
    assert [(r.part, r.product_name) for r in got if r.customer_name == "Bo"] == [(0, ["tea"])]
    assert sorted((r.part, r.n_items) for r in got if r.email_id is None) == [(0, 20), (1, 20), (2, 10)]
    assert sorted((r.part, r.n_items) for r in ann) == [(0, 20), (1, 20), (2, 20), (3, 20), (4, 15)]


def test_daily_weekly_and_monthly_counts_from_bitmaps(spark):
    rows = [("2024-01-01", 1, 10, -5, 1.0, 7), ("2024-01-01", 1, 10, 40_000, 2.5, None), ("2024-01-03", 2, None, 40_000, 1.0, 7),
            ("2024-01-08", 2, 10, 3_000_000_000, 1.0, 8), (None, None, None, None, 4.0, 9), ("2024-02-01", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "date string, location_id int, postal_code int, customer_id long, price double, store_id int").withColumn("date", F.col("date").cast("date"))
    daily = series.daily_metrics(df)
    assert "Expand" not in daily._jdf.queryExecution().executedPlan().toString()
    assert daily.columns == ["date", *series.METRICS]

    def slow(key):
        groups = {}
        for r in df.collect():
            groups.setdefault(key(r.date), []).append(r)
        for k, rs in groups.items():
            counts = [len({r[c] for r in rs} - {None}) for c in ("location_id", "postal_code", "customer_id", "store_id")]
            prices = [r.price for r in rs if r.price is not None]
            yield (k, *counts[:3], sum(prices) if prices else None, counts[3])

    same = lambda got, n: {tuple([tuple(r[:n]) if n > 1 else r[0], *r[n:]]) for r in got.collect()}
    assert same(daily, 1) == set(slow(lambda d: d))
    assert same(series.weekly_metrics(df), 2) == set(slow(lambda d: (d.isocalendar()[0], d.isocalendar()[1]) if d else (None, None)))
    assert same(series.monthly_metrics(df), 2) == set(slow(lambda d: (d.year, d.month) if d else (None, None)))


def mail(folder, refused=(), closed=False):
    """Writes a file per notice sent; a second one of the same notice has another name."""
    folder = str(folder)

    def connect():
        if closed:
            raise ConnectionError

        def send(row):
            if row.email_id in refused:
                raise ConnectionError
            open(f"{folder}/{row.email_id}-{uuid.uuid4().hex}", "w").close()

        return send

    return connect


def states(spark, ledger):
    return Counter(r.status for r in expiry.ledger_state(spark, ledger).collect())


def test_every_notice_is_sent_once_or_open(spark, tmp_path):
    ledger, box = f"file:{tmp_path}/ledger", tmp_path / "box"
    box.mkdir()
    sent = lambda: sorted(p.name.split("-")[0] for p in box.iterdir())
    first = spark.createDataFrame([(c, 0, [c]) for c in "abcdef"] + [("a", 0, ["a"]), ("a", 1, ["a"])], "email_id string, part int, items array<string>").repartition(3)
    assert {r.status for r in expiry.deliver(first, mail(box, closed=True), ledger).collect()} == {"unsent"}
    assert sent() == [] and states(spark, ledger) == {"unsent": 7}
    got = expiry.deliver(first, mail(box, refused=("b", "d")), ledger)
    assert Counter(r.status for r in got.collect()) == {"sent": 5, "open": 2}
    assert sent() == ["a", "a", "c", "e", "f"]
    # What is known is not sent again; what is new is.
    more = first.unionByName(spark.createDataFrame([("g", 0, ["g"])], first.schema))
    assert [r.status for r in expiry.deliver(more, mail(box), ledger).collect()] == ["sent"]
    assert sent() == ["a", "a", "c", "e", "f", "g"] and states(spark, ledger) == {"sent": 6, "open": 2}


def test_a_delivery_lost_half_way_is_open(spark, tmp_path, monkeypatch):
    ledger, box = f"file:{tmp_path}/ledger", tmp_path / "box"
    box.mkdir()
    notices = spark.createDataFrame([(c, 0) for c in "abcd"], "email_id string, part int").repartition(2)

    healthy = mail(box)

    def dies():
        send = healthy()

        def one(row):
            send(row)
            if row.email_id in "bd":
                raise SystemExit  # the worker ends without a word

        return one

    with pytest.raises(Exception):
        expiry.deliver(notices, dies, ledger)
    gone = {p.name.split("-")[0] for p in box.iterdir()}
    assert gone and states(spark, ledger) == {"open": 4}
    assert expiry.deliver(notices, mail(box), ledger).count() == 0
    assert {p.name.split("-")[0] for p in box.iterdir()} == gone


def test_a_second_attempt_sends_nothing(monkeypatch):
    class Second:
        @staticmethod
        def get():
            return type("Task", (), {"attemptNumber": staticmethod(lambda: 1)})

    monkeypatch.setattr(expiry, "TaskContext", Second)
    batch = pa.RecordBatch.from_pylist([{"_notice": "n1", "email_id": "a"}, {"_notice": "n2", "email_id": "b"}])

    def never():
        raise AssertionError("no connection is made")

    got = pa.Table.from_batches(expiry._handed_over(never, "r")(iter([batch]))).to_pylist()
    assert got == [{"notice": n, "run": "r", "status": "open"} for n in ("n1", "n2")]


def test_dynamic_price(spark):
    rules = PricingRules(holiday_discount=1.5, threshold_days_high=30, threshold_days_medium=10, discount_high=0.3, discount_medium=0.1, discount_low_high_consumption=0.6, discount_low_low_consumption=0.5, min_price=2.0)
    df = spark.createDataFrame(
        [(1, 100.0, "2024-02-15", 365, 0.9, None, None), (2, 100.0, "2024-01-21", 365, 0.9, None, None), (3, 100.0, "2024-01-05", 365, 0.9, None, None),
         (4, 100.0, "2024-01-05", 365, 0.5, None, None), (5, 100.0, "2024-01-05", 0, 0.5, None, None), (6, 100.0, "2024-01-05", 10, 0.5, "2", "2024-01-01"), (7, 100.0, "2024-01-05", None, 0.5, None, None)],
        "i int, unit_price double, expected_expiry_date string, avg_expiry_days int, percentage_consumed double, buying_customer_id string, selling_date string")
    import math
    scale = 2 * math.exp(-1)
    got = {r.i: r for r in pricing.price_unsold(df, "2024-01-01", rules).collect()}
    assert [round(got[i].dynamic_price, 6) for i in (1, 2, 3, 4)] == [round(100 * (1 - d * scale), 6) for d in (0.1, 0.3, 0.6, 0.5)]
    assert got[5].dynamic_price == 2.0
    assert (got[6].dynamic_price, got[6].days_to_expiry, got[6].longevity_scale) == (None, None, None)
    assert got[7].dynamic_price is None
    holidays = spark.createDataFrame([(day("2024-01-01"), "ES"), (day("2024-01-01"), "ES"), (day("2024-01-06"), "ES")], "date date, country string")
    festive = {r.i: r.dynamic_price for r in pricing.price_unsold(df, "2024-01-01", rules, holidays).collect()}
    assert round(festive[1], 6) == round(100 * (1 - 0.15 * scale), 6)
    abroad = {r.i: r.dynamic_price for r in pricing.price_unsold(df, "2024-01-01", rules, holidays, "FR").collect()}
    assert abroad[1] == got[1].dynamic_price
    compat = {r.i: r.dynamic_price for r in pricing.price_unsold(df, "2024-01-01", rules, compat=True).collect()}
    assert round(compat[1], 6) == round(100 * (1 - 0.1 * 2 * math.exp(-scale / 365)), 6)


def test_recipes(spark):
    meals = spark.createDataFrame([("Pie", ["200g Apple", "flour"], "bake"), ("Soup", ["leek"], "boil")], "food_name string, ingredients array<string>, description string")
    ready = recipes.prepare_recipes(meals)
    assert [r.ingredients_lower for r in ready.collect()] == ["200g apple, flour", "leek"]
    assert [r.food_name for r in recipes.find_recipes(ready, ["apple", "x.y"]).collect()] == ["Pie"]
    assert recipes.find_recipes(ready, ["(zest"]).count() == 0


def test_indexed_recipes(spark, tmp_path):
    texts = ["Apple pie", "PINEAPPLE, salt", "ſalt and pepper", "İstanbul tea", "Straße", "STRASSE", "a.b (zest)", "", None, "été", "...", "plain flour"]
    rows = [(f"r{i}", t, "d") for i, t in enumerate(texts)] + [(None, "apple", "d")] + [(f"s{i}", f"only word{i}", "d") for i in range(200)]
    meals = spark.createDataFrame(rows, "food_name string, clean_ingredients string, description string")
    recipes.index_recipes(meals, f"file:{tmp_path}/index", parts=16)
    known = meals.where("food_name IS NOT NULL")
    for terms in (["apple"], ["SALT"], ["istanbul"], ["straße", "x"], ["ss"], ["(Zest"], ["ÉT"], ["..."], ["e f", "word19"], ["\\E", "q"], [], ["nowhere"]):
        want = sorted(map(tuple, recipes.find_recipes(known, terms).collect()))
        assert sorted(map(tuple, recipes.find_indexed(spark, f"file:{tmp_path}/index", terms).collect())) == want, terms
    # A rare word leads to one part; only its files are read.
    one = recipes.find_indexed(spark, f"file:{tmp_path}/index", ["word123"])
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_receipt(spark):
    text = "mercat\nMERCADO SUR, .\nC/ Av. Diagonal 12, baixos\n2 PA DE MOTLLE 1,25 2,50\nLLET 0.95\n\\TOTAL+ 3,45\n"
    got = extraction.parse_receipts(spark.createDataFrame([(text,), ("nothing here",), (None,)], "text string")).collect()
    assert got[0].store_name == "MERCADO SUR" and got[0].store_address == "C/ Av. Diagonal 12. baixos"
    assert [tuple(i) for i in got[0]["items"]] == [(2, "PA DE MOTLLE", 1.25, 2.5), (1, "LLET", 0.95, 0.95), (1, "TOTAL", 3.45, 3.45)]
    assert got[1].store_name is None and got[1]["items"] == [] and got[2].store_name is None


def test_invoice(spark):
    answer = 'Sure! {"Invoice no.": "4", "supermarket_name": "M", "products": [{"name": "PA BLANC", "Unit price": "1,25", "quantity": "1", "amount": "1,25"}], "total_price": "1,25"} Bye'
    df = extraction.parse_invoices(spark.createDataFrame([(1, answer), (2, "no json"), (3, "{broken")], "k int, answer string"))
    heads = {r.k: r for r in df.collect()}
    assert heads[1].invoice_no == "4" and heads[1].location is None and heads[2].invoice_no is None
    assert [tuple(r) for r in extraction.invoice_products(df, ["k"]).collect()] == [(1, "Pa Blanc", "1,25", "1", "1,25")]


def test_pages(spark):
    html = ("<html><body><h1 class='t'>Fish &amp; <b>Chips</b></h1><a class='x' href=\"/a\">a</a><ul><li>1 cod</li><li> 2 oil </li></ul>"
            "<p>Fry.</p><p>Eat</p><table><tr><th>Item</th><th>Fridge</th></tr><tr><td>Cod</td><td>2 Days</td><td>extra</td></tr></table></body></html>")
    pages = spark.createDataFrame([(1, html), (2, "<p></p>")], "page_id int, html string")
    one, two = extraction.page_fields(pages, "page_id").orderBy("page_id").collect()
    assert (one.name, one.links, one.entries, one.description) == ("Fish & Chips", ["/a"], ["1 cod", "2 oil"], "Fry. Eat")
    assert (two.name, two.links, two.description) == ("No name found", [], "No description found")
    assert [(r.is_header, r.cells) for r in extraction.table_rows(pages, "page_id").orderBy("row_no").collect()] == [
        (True, ["Item", "Fridge"]), (False, ["Cod", "2 Days", "extra"])]
    assert {(r.heading, r.value) for r in extraction.table_records(pages, "page_id").collect()} == {("item", "Cod"), ("fridge", "2 Days")}


def test_links(spark):
    df = spark.createDataFrame([("https://s/grocery/a/b/c",), ("https://s/g/home-kitchen/b/c",), ("https://s/g/a/b/pr?sid=1",), ("https://s/g/a",)], "url string")
    # Only the first has three levels below the shop, none of them excluded.
    assert [r.url for r in extraction.grocery_links(df).collect()] == ["https://s/grocery/a/b/c"]
    levels = [(r.category, r.sub_category, r.product_group) for r in extraction.link_hierarchy(df).collect()]
    assert levels == [("a", "b", "c"), ("home-kitchen", "b", "c"), ("a", "b", "pr?sid=1"), ("a", None, None)]


def test_store_sales_keep_one_row_per_purchase(spark):
    bought = spark.createDataFrame([(day("2024-01-01"), "x", 1, 7, 2)], "date date, purchase_id string, customer_id long, product_id long, quantity int")
    people = spark.createDataFrame([(1, "Ann")], "customer_id long, customer_name string")
    listed = spark.createDataFrame([("s2", 7, "tea", 3.0, 1), ("s1", 7, "tea", 4.0, 1)], "store_id string, product_id long, product_name string, product_price double, quantity int")
    listed = listed.withColumns({"manufacture_date": F.lit(None).cast("date"), "expiry_date": F.lit(None).cast("date")})
    assert [(r.unit_price, r.quantity) for r in series.store_sales(bought, people, listed).collect()] == [(4.0, 2)]
    assert series.all_store_sales(bought, people, listed).count() == 2


def test_browsers(spark):
    cat = spark.createDataFrame(
        [("food ", "soft-drinks", "cola", 9, "Flipkart"), ("food", " ", "tea", 5, "Flipkart"), ("food", "x", "oil", 5, "Other")],
        "category string, sub_category string, product_name string, avg_expiry_days int, source string")
    view = browse.perishability_view(cat)
    assert [tuple(r) for r in view.collect()] == [("Food", "Soft-Drinks", "Cola", 9)]
    assert browse.browse_perishability(view, {"category": "foo", "product_name": None}, (9, 9)).count() == 1
    assert [r.category for r in browse.pick_list(view, "category", {"sub_category": None}).collect()] == ["Food"]
    items = spark.createDataFrame(
        [("Ann ", "tea", "2024-01-01", day("2024-01-11")), ("Bo", "oil", "2024-01-01", day("2024-01-10"))],
        "customer_name string, product_name string, purchase_date string, expected_expiry_date date")
    shown = browse.browse_expiry(browse.expiry_view(items), {}, ("2024-01-01", "2024-01-01"), ("2024-01-01", "2024-12-31"))
    assert [tuple(r) for r in shown.collect()] == [("Ann", "Tea", "2024-01-01", "2024-01-11")]
    shops = spark.createDataFrame([("1", "full", 41.0, 2.0), ("1", "other", 50.0, 9.0), ("2", "z", 42.0, 2.0)], "store_id string, full_address string, latitude double, longitude double")
    goods = spark.createDataFrame([("1", "A"), ("1", "A"), ("2", "B"), ("3", "C")], "store_id string, store_name string")
    near = browse.closest_stores(goods, shops, [("me", 41.0, 2.0)])
    assert [(r.store_id, r.full_address) for r in near.orderBy("distance_km").collect()] == [("1", "full"), ("2", "z")]


def test_plans_do_not_depend_on_layout(spark):
    """The same rows in another order and partitioning give the same tables."""
    def run(parts):
        raw = purchases(spark).orderBy(F.rand(parts)).repartition(parts)
        bought = cleaning.clean_purchases(raw)
        return sorted(map(tuple, bought.collect())), sorted(map(tuple, star.dim_product(bought, TS).collect()))
    assert run(1) == run(5) == run(9)


def test_receipts_without_prices_are_read_in_linear_time(spark):
    import re
    import time

    from larder.plans import extraction

    texts = ["2 PAN DE MOLDE 1.50 3.00\nLECHE 0.95 A 1.00", "ABC 12 XYZ 1.00", "QUESO% 2.00", "X 1.00 YY  3.50\n\n4 Z Z 1.25 5.00 6.00",
             "12 34 AB 1.00 2.00 3.00 CD 4.00", "É L 1.11", "A1.00 BC1.00 B C 1.00", "  7  UVA BLANCA   12.345.67"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    plain = re.compile(extraction.RECEIPT_ITEM, re.ASCII)
    want = {(i, int(q or 1), n.strip(), float(u)) for i, t in enumerate(texts) for q, n, u, _ in plain.findall(t)}
    got = extraction.receipt_items(extraction.parse_receipts(df), ["id"]).collect()
    assert {(r.id, r.quantity, r.description, r.unit_price) for r in got} == want and len(want) >= 10
    long = spark.createDataFrame([(0, "ABCDE " * 20_000), (1, "1 " * 20_000), (2, "%" * 50_000)], "id int, text string")
    start = time.monotonic()
    assert extraction.receipt_items(extraction.parse_receipts(long), ["id"]).count() == 0
    assert time.monotonic() - start < 20


def test_daily_series_is_fitted_in_as_many_parts_as_its_days_need(spark, monkeypatch):
    days = spark.sql("SELECT explode(sequence(DATE '2000-01-01', DATE '2001-06-30')) AS date").repartition(16).withColumn("y", F.dayofyear("date") * 1.0)
    few = calendar.in_few_parts(days, "date")
    assert few.rdd.getNumPartitions() == 1 and [r["date"] for r in few.collect()] == sorted(r["date"] for r in days.collect())
    monkeypatch.setattr(calendar, "DAYS_A_TASK", 100)
    assert 1 < calendar.in_few_parts(days, "date").rdd.getNumPartitions() <= 6 and calendar.in_few_parts(days, "date").count() == 547
    monkeypatch.undo()
    seen, regressors = [], forecast.regressors

    class Noted:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            return self.estimator.fit(df)

    monkeypatch.setattr(forecast, "regressors", lambda *a: {"linear": Noted(regressors(*a)["linear"])})
    forecast.select_model(days, "date", "y", "2000-12-31")
    assert seen == [1]


def test_sources_of_the_catalogue_are_read_once(spark):
    """Of every text that repeats one is parsed, and the sources are not worked out again to find the ties."""
    raw = [(["A-b", "C", "D e"], "1 Jan 2020", f"{i % 5 + 2} Jan 2020") for i in range(400)] + [(["A-b", "C", None], None, ""), (None, "x", "1 Jan 2020")]
    parsed = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(raw, "prod_heirarachy array<string>, manufacturing_date string, expiry_date string")
    df = df.mapInArrow(noted, df.schema)
    rows = sorted(map(tuple, catalogue.perishability([catalogue.shelf_life_from_dates(df)]).collect()), key=str)
    assert rows == sorted([("a b", "c", "d e", 1, "Flipkart"), ("a b", "c", None, None, "Flipkart"), (None, None, None, None, "Flipkart")], key=str)
    assert parsed.value == len(raw)
