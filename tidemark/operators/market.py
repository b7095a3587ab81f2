"""Market reference prices: the last N prices of a symbol, their freshness, and an as-of lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_n(prices: DataFrame, n: int, key: str = "symbol", order: tuple = ("date",)) -> DataFrame:
    """The N latest rows of each key (W6); Spark keeps N a key before the shuffle."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return prices.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)


def market_reference(prices: DataFrame, asof, n: int = 20, key: str = "symbol", order: tuple = ("date",)) -> DataFrame:
    """`ref_price, ref_type, asof_date, n_days, freshness_days` of each key.

    Mean VWAP of the last N days if at least half (and one) have one, else the
    median close. Freshness counts days up to `asof`.
    """
    last = last_n(prices, n, key, order)
    got = last.groupBy(key).agg(
        F.count("*").alias("n_days"), F.count("vwap").alias("__nv"), F.avg("vwap").alias("__vwap"),
        F.percentile("close", F.lit(0.5)).alias("__close"), F.max("date").alias("asof_date"),
    )
    by_vwap = F.col("__nv") >= F.greatest(F.lit(1), F.floor(F.col("n_days") / 2))
    return got.select(
        key,
        F.when(by_vwap, F.col("__vwap")).otherwise(F.col("__close")).alias("ref_price"),
        F.when(by_vwap, "vwap_mean").when(F.col("__close").isNotNull(), "close_median").alias("ref_type"),
        "asof_date", "n_days",
        F.abs(F.datediff(F.lit(asof).cast("date"), F.col("asof_date"))).alias("freshness_days"),
    )


def with_latest_close(reference: DataFrame, latest: DataFrame, asof, key: str = "symbol") -> DataFrame:
    """`market_reference` filled with the latest close (`key, close, date`) of symbols that have no series, or none with a price."""
    last = latest.where(F.col("close").isNotNull()).groupBy(key).agg(F.max_by(F.struct("close", "date"), F.struct("date", "close")).alias("__l"))
    both = reference.join(last, key, "full")
    have = F.col("ref_price").isNotNull()
    pick = lambda own, other: F.when(have, F.col(own)).otherwise(other).alias(own)
    day = F.col("__l.date").cast("date")
    return both.select(
        key, F.coalesce("ref_price", "__l.close").alias("ref_price"), pick("ref_type", F.when(F.col("__l").isNotNull(), "close")), pick("asof_date", day),
        pick("n_days", F.when(F.col("__l").isNotNull(), 1).cast("long")), pick("freshness_days", F.abs(F.datediff(F.lit(asof).cast("date"), day))),
    )


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Each left row with the latest right `value` at or before its `time`: one union and one window, no range join."""
    both = left.withColumn("__side", F.lit(1)).withColumn(value, F.lit(None).cast(right.schema[value].dataType)).unionByName(right.select(key, time, value).withColumn("__side", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.col(time), F.col("__side")).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(w)).where(F.col("__side") == 1).drop("__side")
