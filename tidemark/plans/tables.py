"""The driver's tables as the engine's relations: a filing is an order, a transaction a line item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASOF = "2001-12-01"
#: A full order of line items: (l_orderkey, l_linenumber) alone has ties.
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """`filing_id, symbol_id, type, price, amount, value` and further line item columns."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    kind = F.when(F.col("l_returnflag") == "R", "buy").when(F.col("l_returnflag") == "A", "sell").otherwise("others")
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("filing_id"), F.col("l_partkey").alias("symbol_id"), kind.alias("type"), price.alias("price"), F.col("l_quantity").cast("long").alias("amount"), F.col("l_extendedprice").cast("decimal(18,2)").alias("value"), *more)


#: The same relation for DuckDB.
TX = """tx AS (SELECT l_orderkey AS filing_id, l_partkey AS symbol_id, CASE l_returnflag WHEN 'R' THEN 'buy' WHEN 'A' THEN 'sell' ELSE 'others' END AS type,
 l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS amount, CAST(l_extendedprice AS DECIMAL(18,2)) AS value, * FROM lineitem)"""
