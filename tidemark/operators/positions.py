"""Aggregations over transactions: weighted prices, net positions, medians, ownership models.

Input rows are transactions with a filing key and the columns `type, price,
amount, value`; all of these aggregate with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import floor_places


def of_type(*types: str) -> Column:
    return F.coalesce(F.col("type").isin(*types), F.lit(False))


def wap(tx: DataFrame, key: str) -> DataFrame:
    """`total_amount, total_value, wap` of buys and sells with positive price and amount; all null without such rows (A1, A4)."""
    good = of_type("buy", "sell") & (F.col("price") > 0) & (F.col("amount") > 0)
    out = tx.groupBy(key).agg(F.sum(F.when(good, F.col("amount"))).alias("total_amount"), F.sum(F.when(good, F.col("value"))).alias("total_value"))
    return out.withColumn("total_value", F.col("total_value").cast("double")).withColumn("wap", F.try_divide(F.col("total_value"), F.col("total_amount").cast("double")))


def net_position(tx: DataFrame, key: str) -> DataFrame:
    """Buys less sells: type by the sign of the net value, price of the net shares (0 without any), absolute value (A2).

    A filing with neither buys nor sells is others, priced by its own weighted average.
    """
    side = lambda t, c: F.coalesce(F.sum(F.when(of_type(t), F.col(c))), F.lit(0))
    sums = tx.groupBy(key).agg(
        (side("buy", "value") - side("sell", "value")).cast("double").alias("net_value"),
        (side("buy", "amount") - side("sell", "amount")).cast("double").alias("net_amount"),
        F.sum(F.when(~of_type("buy", "sell"), F.col("value"))).cast("double").alias("other_value"),
        F.sum(F.when(~of_type("buy", "sell"), F.col("amount"))).cast("double").alias("other_amount"),
        F.max(of_type("buy", "sell")).alias("trades"),
    )
    trades = F.col("trades")
    price = F.when(trades, F.when(F.col("net_amount") == 0, 0.0).otherwise(F.abs(F.col("net_value") / F.nullif(F.col("net_amount"), F.lit(0.0))))).otherwise(F.coalesce(F.try_divide("other_value", "other_amount"), F.lit(0.0)))
    return sums.select(
        key,
        F.when(~trades, "others").when(F.col("net_value") > 0, "buy").when(F.col("net_value") < 0, "sell").otherwise("others").alias("net_type"),
        F.round(price.cast("decimal(30,6)"), 3).cast("double").alias("net_price"),
        F.abs(F.when(trades, F.col("net_value")).otherwise(F.coalesce("other_value", F.lit(0.0)))).cast("long").alias("net_value"),
        F.abs(F.when(trades, F.col("net_amount")).otherwise(F.coalesce("other_amount", F.lit(0.0)))).cast("long").alias("net_shares"),
    )


def class_totals(tx: DataFrame, key: str) -> DataFrame:
    """Amounts and values of buys, sells and the rest, and which kinds occur."""
    other = ~of_type("buy", "sell")
    part = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("double")
    return tx.groupBy(key).agg(
        part(of_type("buy"), "amount").alias("buy_amount"), part(of_type("sell"), "amount").alias("sell_amount"), part(other, "amount").alias("other_amount"),
        part(of_type("buy"), "value").alias("buy_value"), part(of_type("sell"), "value").alias("sell_value"), part(other, "value").alias("other_value"),
        F.max(of_type("buy", "sell")).alias("has_buy_sell"), F.max(other).alias("has_other"),
        (~F.max(of_type("buy", "sell")) & F.min(F.coalesce(F.col("type").isin("transfer", "other", ""), F.lit(True)))).alias("transfer_only"),
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("kinds"),
    )


def document_median(tx: DataFrame, key: str) -> DataFrame:
    """`doc_median`: exact median of a filing's positive prices (A5)."""
    return tx.groupBy(key).agg(F.percentile(F.when(F.col("price") > 0, F.col("price")), F.lit(0.5)).alias("doc_median"))


def signed_amount() -> Column:
    """Plus for a buy, minus for a sell, 0 else."""
    return F.when(of_type("buy"), F.col("amount")).when(of_type("sell"), -F.col("amount")).otherwise(0)


def total_shares(before: Column, pct_before: Column, after: Column, pct_after: Column) -> Column:
    """Shares outstanding that a holding and its percent imply, the ones before preferred."""
    one = lambda h, p: F.when(p > 0, h / (p / 100.0))
    return F.coalesce(one(before, pct_before), one(after, pct_after))


def percent_model(rows: DataFrame, tolerance: float = 0.25) -> DataFrame:
    """Adds `total_shares_model, delta_pp_model, pp_after_model, discrepancy_pp, percent_discrepancy`.

    Needs `holding_before, holding_after, share_percentage_before, share_percentage_after, net_signed`.
    Percents are floored to three decimals, as they are stored.
    """
    shares = total_shares(F.col("holding_before").cast("double"), F.col("share_percentage_before"), F.col("holding_after").cast("double"), F.col("share_percentage_after"))
    out = rows.withColumn("total_shares_model", F.when(shares > 0, shares))
    out = out.withColumn("delta_pp_model", floor_places(F.col("net_signed") / F.col("total_shares_model") * 100.0))
    out = out.withColumn("pp_after_model", floor_places(F.col("share_percentage_before") + F.col("delta_pp_model")))
    gap = F.abs(F.col("pp_after_model") - floor_places(F.col("share_percentage_after")))
    return out.withColumn("discrepancy_pp", gap).withColumn("percent_discrepancy", F.coalesce(gap > tolerance, F.lit(False)))


def attach_computed(rows: DataFrame, tx: DataFrame, key: str) -> DataFrame:
    """Rows with `price, transaction_value, transaction_type` of their transactions' net position, and `amount_transaction`, the change of the holding (X11).

    Rows without transactions get nulls; the amount is null if either holding is.
    """
    net = net_position(tx, key).select(key, F.col("net_price").alias("price"), F.col("net_value").cast("double").alias("transaction_value"), F.col("net_type").alias("transaction_type"))
    kept = [c for c in rows.columns if c not in ("price", "transaction_value", "transaction_type", "amount_transaction")]
    return rows.select(*kept).join(net, key, "left").withColumn("amount_transaction", F.abs(F.col("holding_before") - F.col("holding_after")))


def price_phrase(prices: Column) -> Column:
    """'at X' or 'between X and Y' of an array of prices."""
    lo, hi = F.array_min(prices), F.array_max(prices)
    return F.when(lo == hi, F.format_string("at %.2f", lo)).otherwise(F.format_string("between %.2f and %.2f", lo, hi))


def checksum(df: DataFrame, key: str, *values: str) -> DataFrame:
    """One row: sha256 over `key|values` lines in order of the line, whatever the order of rows (A16). For dimension tables: one line each."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *values)])
    return df.select(line.alias("line")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("line")), "\n"), 256).alias("checksum"), F.count("*").alias("row_count"))
