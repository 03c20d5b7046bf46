"""Expected expiry of purchases and the notices sent about it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from larder.functions.dates import parse_iso
from larder.functions.similarity import keep_content_words
from larder.operators.fuzzy import best_match
from larder.operators.keys import content_key, dense_key
from larder.session import materialize

# Notification horizon in days.
DAYS_CONSIDERED = 20

EXPIRY_COLUMNS = (
    "id", "customer_id", "customer_name", "email_id", "product_name", "unit_price", "quantity",
    "purchase_date", "avg_expiry_days", "expected_expiry_date",
)


def product_shelf_life(
    catalogue: DataFrame, products: DataFrame, method: str = "partial_token_sort_ratio",
    threshold: int = 80, ignore_words: tuple[str, ...] = (),
) -> DataFrame:
    """(product, avg_expiry_days): each catalogue product hands its shelf life to the
    purchased product it resembles most. One purchased product may receive several."""
    life = catalogue.groupBy("product_name").agg(F.min("avg_expiry_days").alias("avg_expiry_days"))
    life = life.withColumn("match_name", keep_content_words(F.col("product_name"), ignore_words))
    best = best_match(life, products, "match_name", "product", method, threshold)
    return life.join(best, "match_name").select("product", "avg_expiry_days")


def expected_expiry(
    purchases: DataFrame, customers: DataFrame, catalogue: DataFrame,
    method: str = "partial_token_sort_ratio", threshold: int = 80, ignore_words: tuple[str, ...] = (),
) -> DataFrame:
    """Purchases with the day half their product's shelf life is over.

    A product that several catalogue entries picked yields one row per entry, as
    in the original job.
    """
    names = purchases.select(F.col("product_name").alias("product")).distinct()
    # Stored, so that Spark sees its size and can split hot products in the join below.
    life = materialize(
        product_shelf_life(catalogue, names, method, threshold, ignore_words).where("avg_expiry_days > 0"), "life"
    )
    half = F.ceil(F.col("avg_expiry_days") / 2).cast("int")
    return (
        purchases.join(life, purchases["product_name"] == life["product"])
        .join(customers.select("customer_id", "email_id"), "customer_id")
        .withColumn("expected_expiry_date", F.date_add(parse_iso(F.col("purchase_date")), half))
        .select(*EXPIRY_COLUMNS)
    )


def expiring_items(expiry: DataFrame, as_of: str, days: int = DAYS_CONSIDERED) -> DataFrame:
    left = F.datediff(F.col("expected_expiry_date"), F.lit(as_of).cast("date"))
    return expiry.withColumn("remaining_days", left).where((left > 0) & (left < days))


def notices(
    expiry: DataFrame, as_of: str, days: int = DAYS_CONSIDERED, line_key: str = "id", lines_per_notice: int = 1000,
) -> DataFrame:
    """Numbered notices per customer with the expiring items, as lists and as an HTML table.

    The items of a customer are numbered by date, product and ``line_key``; notice 0 holds
    the first ``lines_per_notice`` of them, notice 1 the next, and so on. Numbers come from
    positions in the whole order, so no task gathers a customer's items, and customers
    without a name or an e-mail address are treated like any other.
    """
    who = ["email_id", "customer_name"]
    lines = expiring_items(expiry, as_of, days).select(*who, "expected_expiry_date", "product_name", line_key)
    placed = dense_key(lines, [*who, "expected_expiry_date", "product_name", line_key], "_place", 0)
    placed = materialize(placed, "lines")
    firsts = placed.groupBy(*[F.col(c).alias(f"_{c}") for c in who]).agg(F.min("_place").alias("_first"))
    same = F.lit(True)
    for c in who:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    number = F.floor((F.col("_place") - F.col("_first")) / lines_per_notice).cast("int")
    item = F.struct("expected_expiry_date", "product_name")
    rows = F.transform("items", lambda i: F.concat(
        F.lit("<tr><td>"), i["product_name"], F.lit("</td><td>"),
        i["expected_expiry_date"].cast("string"), F.lit("</td></tr>")))
    return (
        placed.join(firsts, same)
        .groupBy(*who, number.alias("part"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select(
            *who, "part",
            F.size("items").alias("n_items"),
            F.transform("items", lambda i: i["product_name"]).alias("product_name"),
            F.transform("items", lambda i: i["expected_expiry_date"]).alias("expected_expiry_date"),
            F.concat(
                F.lit("<p>Dear "), F.col("customer_name"), F.lit(",</p><table>"),
                F.array_join(rows, ""), F.lit("</table>"),
            ).alias("html"),
        )
    )


_LEDGER = "notice string, run string, status string"


def _handed_over(connect: Callable[[], Callable[[Row], None]], run: str) -> Callable:
    """Sends the rows of a partition, and says of each what became of it."""

    def send_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # An earlier attempt at this partition was lost, and nobody knows how far it got.
        send, status = None, "open"
        if TaskContext.get().attemptNumber() == 0:
            try:
                send = connect()
            except Exception:
                status = "unsent"
        for batch in batches:
            outcomes = []
            for cells in batch.to_pylist() if send else ():
                cells.pop("_notice")
                try:
                    send(Row(**cells))
                    outcomes.append("sent")
                except Exception:
                    outcomes.append("open")
            yield pa.RecordBatch.from_arrays(
                [batch.column("_notice"), pa.array([run] * len(batch), pa.string()), pa.array(outcomes if send else [status] * len(batch), pa.string())],
                names=["notice", "run", "status"])

    return send_all


def ledger_state(spark: SparkSession, ledger: str) -> DataFrame:
    """``notice``, ``status`` of every notice that a delivery took up: sent, unsent, or open.

    Open are those whose sending failed or whose outcome was lost with a task or a driver: they may have
    arrived. Unsent are those for which no connection could be made; the next delivery takes them up again.
    """
    rows = spark.read.schema(_LEDGER).parquet(ledger)
    by = rows.groupBy("notice").agg(
        F.max(F.col("status") == "sent").alias("sent"), F.max(F.col("status") == "open").alias("open"),
        F.sum(F.expr("CASE status WHEN 'taken' THEN 1 WHEN 'unsent' THEN -1 ELSE 0 END")).alias("left"))
    return by.select("notice", F.when(F.col("sent"), "sent").when(F.col("open") | (F.col("left") > 0), "open").otherwise("unsent").alias("status"))


def deliver(notices_: DataFrame, connect: Callable[[], Callable[[Row], None]], ledger: str) -> DataFrame:
    """Send every notice at most once, and keep account in ``ledger``, a table only this function writes.

    ``connect`` is called once per partition and returns the function that sends one notice. Notices (told apart by
    all their columns) that the ledger knows as sent or open are left out. The others are entered as taken before any
    is sent, and their outcomes are committed by the task that sent them; a task that runs again sends nothing. What
    has no outcome in the end is open, never sent twice. One delivery at a time may use a ledger. Returns the
    outcomes of this run: ``notice``, ``run``, ``status``.
    """
    spark, run = notices_.sparkSession, uuid.uuid4().hex
    spark.createDataFrame([], _LEDGER).write.mode("append").parquet(ledger)
    settled = ledger_state(spark, ledger).where("status <> 'unsent'").withColumnRenamed("notice", "_notice")
    plain = [F.col(c) if not isinstance(f.dataType, (T.ArrayType, T.StructType)) else F.to_json(c) for c, f in zip(notices_.columns, notices_.schema)]
    todo = notices_.withColumn("_notice", content_key(*plain)).dropDuplicates(["_notice"])
    todo = materialize(todo.join(settled, "_notice", "left_anti"), "notices")
    todo.select(F.col("_notice").alias("notice"), F.lit(run).alias("run"), F.lit("taken").alias("status")).write.mode("append").parquet(ledger)
    todo.mapInArrow(_handed_over(connect, run), _LEDGER).write.mode("append").parquet(ledger)
    return spark.read.schema(_LEDGER).parquet(ledger).where((F.col("run") == run) & (F.col("status") != "taken"))
