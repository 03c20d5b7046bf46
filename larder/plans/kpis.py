"""Customer KPIs over the inventory fact and the date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from larder.functions.dates import month_before


def _dated(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows whose date key is in the date dimension ."""
    days = dates.select(F.col("date_id").cast("string").alias("purchase_date_id"), "date", "year", "month")
    return fact.join(days, "purchase_date_id")


def active_customers(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Distinct buyers per month. The original calls this column new_customers."""
    return (
        _dated(fact, dates).groupBy("year", "month")
        .agg(F.countDistinct("customer_id").alias("new_customers"))
        .orderBy("year", "month")
    )


def _first_days(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return _dated(fact, dates).groupBy("customer_id").agg(F.min("date").alias("day"))


def first_time_customers(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Customers per month of their first purchase."""
    first = _first_days(fact, dates).where("customer_id is not null")
    return (
        first.groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.count("*").alias("first_time_customers")).orderBy("year", "month")
    )


def retention(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Customers per month with a purchase after their first day.

    Purchases collapse to one row per customer and month in the tasks that read
    them: the last day of the month tells whether any purchase lies after the
    first day, so the fact is read once and never joined to itself.
    """
    months = (
        _dated(fact, dates).where("customer_id is not null")
        .groupBy("customer_id", "year", "month")
        .agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    )
    first = F.min("lo").over(Window.partitionBy("customer_id"))
    return (
        months.withColumn("first", first).where("hi > first")
        .groupBy("year", "month").agg(F.count("*").alias("repeat_customers"))
        .orderBy("year", "month")
    )


def average_lifetime_value(fact: DataFrame, digits: int = 6) -> DataFrame:
    """Mean over customers of their total spend."""
    spend = F.col("quantity").cast("int") * F.col("unit_price").try_cast("double")
    return (
        fact.groupBy("customer_id").agg(F.sum(spend).alias("total_revenue"))
        .agg(F.round(F.avg("total_revenue"), digits).alias("average_clv"))
    )


def churn(fact: DataFrame, dates: DataFrame, as_of: str) -> DataFrame:
    """Customers whose last purchase is over a month before ``as_of``, by its month."""
    last = (
        _dated(fact, dates).where("customer_id is not null")
        .groupBy("customer_id").agg(F.max("date").alias("day"))
    )
    return (
        last.where(F.col("day") < month_before(F.lit(as_of).cast("date")))
        .groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.count("*").alias("churned_customers")).orderBy("year", "month")
    )


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Expose tables to ``spark.sql``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def lifetime_value_view(spark: SparkSession, fact_view: str = "fact_cust_inventory", name: str = "average_clv") -> DataFrame:
    """The lifetime value as a SQL view over a registered fact."""
    spark.sql(f"""
        CREATE OR REPLACE TEMP VIEW {name} AS
        SELECT round(avg(total_revenue), 6) AS average_clv
        FROM (
            SELECT customer_id, sum(CAST(quantity AS INT) * try_cast(unit_price AS DOUBLE)) AS total_revenue
            FROM {fact_view} GROUP BY customer_id
        )
    """)
    return spark.table(name)
