"""The roles that the test tables play."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a date; money as exact decimals."""
    return table(spark, sf, "orders").withColumn("order_day", F.to_date("o_orderdate")).withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a day, the entity out of their properties, and the day they became knowable."""
    e = table(spark, sf, "events").withColumn("event_day", F.to_date("ts"))
    e = e.withColumn("entity", F.get_json_object("props", "$.k").cast("long")).withColumn("amount", F.col("value").cast("decimal(18,2)"))
    return e.withColumn("knowable_day", F.date_add("event_day", (F.col("event_id") % 6).cast("int")))


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).where("event_type = 'purchase' and entity is not null")


#: The same in DuckDB.
EVENTS_SQL = """ev AS (SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS amount, props,
  CAST(ts AS DATE) AS event_day, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS entity,
  CAST(CAST(ts AS DATE) + CAST(event_id % 6 AS INTEGER) AS DATE) AS knowable_day FROM events)"""
PURCHASES_SQL = EVENTS_SQL + ", pu AS (SELECT * FROM ev WHERE event_type = 'purchase' AND entity IS NOT NULL)"
ORDERS_SQL = "od AS (SELECT *, CAST(o_orderdate AS DATE) AS order_day, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)"
