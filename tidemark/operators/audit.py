"""Audit rules: each row gets an ordered array of reason structs, then a gate decides.

Rules are built as `array(when(...), ...)` without nulls, so that all of them are
evaluated in one projection; transaction rules come from the row's array.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import structure_is_valid
from ..functions.numbers import missing_zero, ratio


@dataclass(frozen=True)
class AuditConfig:
    """Thresholds of the rules."""

    doc_low: float = 0.5
    doc_high: float = 1.5
    market_low: float = 0.6
    market_high: float = 1.4
    percent_tolerance: float = 0.25
    stale_days: int = 14
    direction_slack: float = 1e-3
    gate: tuple[str, ...] = ("suspicious_price_level", "percent_discrepancy", "stale_price", "missing_price", "delta_pp_mismatch")


def reason(scope: str, code: str, message: Column, brief: bool = False, **details: Column) -> Column:
    """struct<scope, code, message, details>; `brief` leaves out what is made for reading."""
    if brief:
        return F.struct(F.lit(scope).alias("scope"), F.lit(code).alias("code"))
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return F.struct(F.lit(scope).alias("scope"), F.lit(code).alias("code"), message.alias("message"), (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("details"))


def _present(*parts: Column) -> Column:
    return F.filter(F.array(*parts), lambda r: r.isNotNull())


def price_flags(price: Column, median: Column, market: Column, cfg: AuditConfig = AuditConfig()) -> dict[str, Column]:
    """Rules 8-10 as booleans: off the document median, off the market, a zero missing (of the market if known, else of the median)."""
    some = price > 0
    off = lambda ref, lo, hi: F.coalesce(some & (ref > 0) & ((ratio(price, ref) < lo) | (ratio(price, ref) > hi)), F.lit(False))
    zero = F.when(F.coalesce(market, F.lit(0.0)) != 0, missing_zero(price, market)).otherwise(missing_zero(price, median))
    return {
        "price_deviation_within_doc": off(median, cfg.doc_low, cfg.doc_high),
        "price_deviation_vs_market": off(market, cfg.market_low, cfg.market_high),
        "possible_zero_missing": F.coalesce(some, F.lit(False)) & zero.isNotNull(),
    }


def tx_reasons(txs: Column, median: Column, market: Column, cfg: AuditConfig = AuditConfig(), brief: bool = False) -> Column:
    """Reasons of an array of transactions, in their order (rules 8-10)."""

    def of(t: Column) -> Column:
        flags = price_flags(t["price"], median, market, cfg)
        say = lambda code, what, ref: F.when(flags[code], reason("tx", code, F.format_string(what, ratio(t["price"], ref)), brief, price=t["price"], reference=ref, ratio=F.round(ratio(t["price"], ref), 3)))
        ref = F.coalesce(F.nullif(market, F.lit(0.0)), median)
        return _present(
            say("price_deviation_within_doc", "price is %.3f of the document median", median),
            say("price_deviation_vs_market", "price is %.3f of the market reference", market),
            say("possible_zero_missing", "price is %.3f of its reference: a zero may be missing", ref),
        )

    return F.flatten(F.transform(F.coalesce(txs, F.array().cast("array<struct<date:string,type:string,price:double,amount:bigint>>")), of))


def direction_mismatch(before: Column, after: Column, type_: Column, slack: float = 1e-3) -> Column:
    """Why holdings contradict the type, or null (rule 4); missing holdings count as a contradiction."""
    t = F.lower(F.trim(type_))
    return F.when(before.isNull() | after.isNull(), "missing_before_or_after").when((t == "buy") & (after + slack < before), "inconsistent_buy").when((t == "sell") & (after > before + slack), "inconsistent_sell")


def kinds_of(txs: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(txs, lambda t: F.lower(F.coalesce(t["type"], F.lit(""))))))


def row_reasons(cfg: AuditConfig = AuditConfig(), brief: bool = False) -> Column:
    """Rules 1-7 over `freshness_days, ref_price, amount_transaction, holding_before, holding_after, price, transaction_value, transaction_type, txs`."""
    c = F.col
    need = ("amount_transaction", "holding_before", "holding_after", "price", "transaction_value")
    missing = F.filter(F.array(*[F.when(c(n).isNull(), n) for n in need]), lambda n: n.isNotNull())
    why = direction_mismatch(c("holding_before"), c("holding_after"), c("transaction_type"), cfg.direction_slack)
    kinds = kinds_of(c("txs"))
    trades = F.arrays_overlap(kinds, F.array(F.lit("buy"), F.lit("sell")))
    others = F.size(F.array_except(kinds, F.array(F.lit("buy"), F.lit("sell"), F.lit("")))) > 0
    only = ~trades & (F.size(kinds) > 0) & (F.size(F.array_except(kinds, F.array(F.lit("transfer"), F.lit("other"), F.lit("")))) == 0)
    valid = structure_is_valid(c("txs"), c("transaction_type"))
    row = lambda code, message, **details: reason("row", code, message, brief, **details)
    return _present(
        F.when(c("freshness_days") > cfg.stale_days, row("stale_price", F.format_string("reference price is %d days old", c("freshness_days")), freshness_days=c("freshness_days"))),
        F.when(c("ref_price").isNull(), row("missing_price", F.lit("no reference price"))),
        F.when(F.size(missing) > 0, row("missing_required_field", F.concat(F.lit("missing: "), F.array_join(missing, ", ")), missing_fields=F.array_join(missing, ","))),
        F.when(why.isNotNull(), row("mismatch_transaction_type", why, holding_before=c("holding_before"), holding_after=c("holding_after"))),
        F.when(only, row("transfer_only_transaction", F.lit("only transfers or others"), kinds=F.array_join(kinds, ","))),
        F.when(trades & others, row("mixed_transaction_type", F.lit("trades beside transfers or others"), kinds=F.array_join(kinds, ","))),
        F.when(~valid, row("invalid_price_transaction", F.lit("transactions without date, type or amount"))),
    )


def audit(rows: DataFrame, cfg: AuditConfig = AuditConfig(), brief: bool = False) -> DataFrame:
    """Adds `reasons, needs_review, skip_reason` to rows that `percent_model` and a market reference have been joined to (needs `doc_median`).

    An earlier transfer or mixed skip reason stays; else the first gated code, else
    suspicious_price_level if any transaction rule fired. `brief` reasons have a
    scope and a code only: enough to gate and to count, and nothing is formatted.
    """
    pct = F.when(F.col("percent_discrepancy"), reason("row", "percent_discrepancy", F.format_string("model is off by %.5f points", F.col("discrepancy_pp")), brief, discrepancy_pp=F.col("discrepancy_pp")))
    out = rows.withColumn("reasons", F.concat(row_reasons(cfg, brief), tx_reasons(F.col("txs"), F.col("doc_median"), F.col("ref_price"), cfg, brief), _present(pct)))
    codes = F.transform("reasons", lambda r: r["code"])
    early = F.get(F.filter(codes, lambda k: k.isin("transfer_only_transaction", "mixed_transaction_type")), F.lit(0))
    gated = F.get(F.filter(codes, lambda k: k.isin(*cfg.gate)), F.lit(0))
    level = F.when(F.exists("reasons", lambda r: r["scope"] == "tx"), "suspicious_price_level")
    out = out.withColumn("skip_reason", F.coalesce(early, gated, level))
    return out.withColumn("needs_review", F.col("skip_reason").isNotNull())


def by_code(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each filing and reason code, with how many and the first place."""
    each = rows.select(*keys, F.posexplode("reasons").alias("pos", "r"))
    return each.groupBy(*keys, F.col("r.code").alias("code")).agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
