"""Inputs derived by Spark from the given tables, and the contracts the
driver queries use for them. Every derived input keeps all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import TableContract
from strandline.functions.columns import RESCUED

ORDERS = TableContract("orders", "orders", "bronze.orders", "o_orderkey",
                       {"o_totalprice": "double"}, ("o_totalprice",))
EVENTS = TableContract("events", "events", "bronze.events", "event_id",
                       {"value": "double"}, ("value",))
CUSTOMER = TableContract("customer", "customer", "bronze.customer", "c_custkey",
                         {"c_acctbal": "double"})
LINEITEM = TableContract("lineitem", "lineitem", "bronze.lineitem", "l_orderkey", {
    "l_orderkey": "long", "l_partkey": "long", "l_suppkey": "long", "l_linenumber": "long",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double",
})
PLAN_CONTRACTS = {c.name: c for c in (ORDERS, EVENTS, CUSTOMER, LINEITEM)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dirty_orders(orders: DataFrame) -> DataFrame:
    """``dirty(orders)``: price text moved to the rescued JSON for keys that
    are multiples of 7 ('N/A' for multiples of 49); the price is NULL there."""
    k = F.col("o_orderkey")
    text = F.to_json(F.struct(F.col("o_totalprice").cast("string").alias("o_totalprice")))
    rescued = (F.when(k % 49 == 0, F.lit('{"o_totalprice":"N/A"}'))
               .when(k % 7 == 0, text))
    return orders.select(
        *[F.col(c) for c in orders.columns if c != "o_totalprice"],
        F.when(rescued.isNull(), F.col("o_totalprice")).alias("o_totalprice"),
        rescued.alias(RESCUED))


def null_keys(df: DataFrame, every: int = 70, key: str = "o_orderkey") -> DataFrame:
    """The NULL-key variant: the key is NULL where it is a multiple of ``every``."""
    return df.withColumn(key, F.when(F.col(key) % every != 0, F.col(key)))


def events_landing(events: DataFrame) -> DataFrame:
    """Events as a feed sends them: ``value`` as text, 'n/a' where the event
    is an error or its id a multiple of 37."""
    bad = (F.col("event_type") == "error") | (F.col("event_id") % 37 == 0)
    return events.select(
        *[F.col(c) for c in events.columns if c != "value"],
        F.when(bad, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"))


def events_flagship_landing(events: DataFrame) -> DataFrame:
    """Events with an upstream rescued column: error events carry the text
    'n/a' for value; other events whose id is a multiple of 7 arrive with the
    value moved into ``_rescued_data``; the rest carry the value as text."""
    err = F.col("event_type") == "error"
    moved = ~err & (F.col("event_id") % 7 == 0)
    text = F.col("value").cast("string")
    return events.select(
        *[F.col(c) for c in events.columns if c != "value"],
        F.when(err, F.lit("n/a")).when(moved, F.lit(None)).otherwise(text).alias("value"),
        F.when(moved, F.to_json(F.struct(text.alias("value")))).alias(RESCUED))


def write_drop(df: DataFrame, folder: str, files: int | None = None) -> str:
    """Drops ``df`` as Parquet files into a landing folder (appends files)."""
    (df if files is None else df.repartition(files)).write.mode("append").parquet(folder)
    return folder
