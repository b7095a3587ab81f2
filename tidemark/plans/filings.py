"""Queries over transactions: aggregates, market references, audit rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import audit, lookup, market, positions
from .tables import ASOF, ORDER, TX, read, transactions

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


@query(f"""WITH {TX} SELECT filing_id, sum(amount) FILTER (type IN ('buy','sell')) AS total_amount, CAST(sum(value) FILTER (type IN ('buy','sell')) AS DOUBLE) AS total_value,
 round(CAST(sum(value) FILTER (type IN ('buy','sell')) AS DOUBLE) / sum(amount) FILTER (type IN ('buy','sell')), 6) AS wap FROM tx GROUP BY filing_id""")
def filing_wap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(positions.wap(transactions(spark, sf_dir), "filing_id"), 6, "wap")


@query(f"""WITH {TX}, s AS (SELECT filing_id, CAST(coalesce(sum(value) FILTER (type='buy'),0) - coalesce(sum(value) FILTER (type='sell'),0) AS DOUBLE) AS nv,
 CAST(coalesce(sum(amount) FILTER (type='buy'),0) - coalesce(sum(amount) FILTER (type='sell'),0) AS DOUBLE) AS na, CAST(sum(value) FILTER (type='others') AS DOUBLE) AS ov, CAST(sum(amount) FILTER (type='others') AS DOUBLE) AS oa, bool_or(type IN ('buy','sell')) AS t FROM tx GROUP BY filing_id)
 SELECT filing_id, CASE WHEN NOT t THEN 'others' WHEN nv > 0 THEN 'buy' WHEN nv < 0 THEN 'sell' ELSE 'others' END AS net_type,
 CAST(round(CAST(CASE WHEN t THEN CASE WHEN na = 0 THEN 0.0 ELSE abs(nv / na) END ELSE coalesce(ov / nullif(oa, 0), 0.0) END AS DECIMAL(30,6)), 3) AS DOUBLE) AS net_price,
 CAST(trunc(abs(CASE WHEN t THEN nv ELSE coalesce(ov, 0) END)) AS BIGINT) AS net_value, CAST(abs(CASE WHEN t THEN na ELSE coalesce(oa, 0) END) AS BIGINT) AS net_shares FROM s""")
def filing_net_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.net_position(transactions(spark, sf_dir), "filing_id")


@query(f"""WITH {TX} SELECT filing_id, {', '.join(f"CAST(coalesce(sum({c}) FILTER (type='{t}'),0) AS DOUBLE) AS {n}_{c}" for c in ('amount', 'value') for t, n in (('buy', 'buy'), ('sell', 'sell'), ('others', 'other')))},
 bool_or(type IN ('buy','sell')) AS has_buy_sell, bool_or(type NOT IN ('buy','sell')) AS has_other, false AS transfer_only, string_agg(DISTINCT type, ',' ORDER BY type) AS kinds FROM tx GROUP BY filing_id""")
def filing_class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.class_totals(transactions(spark, sf_dir), "filing_id")


@query(f"""WITH {TX}, m AS (SELECT filing_id, median(price) AS doc_median FROM tx GROUP BY filing_id)
 SELECT filing_id, round(doc_median, 6) AS doc_median, count(*) FILTER (price / doc_median < 0.5 OR price / doc_median > 1.5) AS n_outliers, count(*) AS n FROM tx JOIN m USING (filing_id) GROUP BY filing_id, doc_median""")
def doc_median_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    got = tx.join(positions.document_median(tx, "filing_id"), "filing_id")
    flag = audit.price_flags(F.col("price"), F.col("doc_median"), F.lit(None).cast("double"))["price_deviation_within_doc"]
    return got.groupBy("filing_id", F.round("doc_median", 6).alias("doc_median")).agg(F.count_if(flag).alias("n_outliers"), F.count("*").alias("n"))


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price row of each line item: the part is the symbol, a seventh of the rows lacks a VWAP."""
    vwap = F.when(F.col("l_linenumber") % 7 != 0, F.col("l_extendedprice") / F.col("l_quantity"))
    return read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("close"), vwap.alias("vwap"), *ORDER)


@query(f"""WITH r AS (SELECT l_partkey AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS close, CASE WHEN l_linenumber % 7 <> 0 THEN l_extendedprice / l_quantity END AS vwap,
 row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC, {', '.join(c + ' DESC' for c in ORDER)}) AS rn FROM lineitem),
 g AS (SELECT symbol, count(*) AS n_days, count(vwap) AS nv, avg(vwap) AS av, median(close) AS mc, max(date) AS asof_date FROM r WHERE rn <= 20 GROUP BY symbol)
 SELECT symbol, round(CASE WHEN nv >= greatest(1, n_days // 2) THEN av ELSE mc END, 6) AS ref_price, CASE WHEN nv >= greatest(1, n_days // 2) THEN 'vwap_mean' WHEN mc IS NOT NULL THEN 'close_median' END AS ref_type, asof_date, n_days, CAST(abs(date_diff('day', asof_date, DATE '{ASOF}')) AS INTEGER) AS freshness_days FROM g""")
def market_reference_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(market.market_reference(_prices(spark, sf_dir), ASOF, 20, "symbol", ("date", *ORDER)), 6, "ref_price")


@query(f"""WITH {TX}, m AS (SELECT symbol_id, median(price) AS ref FROM tx GROUP BY symbol_id), f AS (SELECT symbol_id, price / ref AS r FROM tx JOIN m USING (symbol_id))
 SELECT symbol_id, count(*) FILTER (r < 0.6 OR r > 1.4) AS n_market, count(*) FILTER (r BETWEEN 8 AND 15 OR r BETWEEN 80 AND 150) AS n_zero, count(*) AS n FROM f GROUP BY symbol_id""")
def price_vs_market_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "l_shipdate")
    prices = tx.select("symbol_id", F.col("l_shipdate").cast("date").alias("date"), F.col("price").alias("close"), F.lit(None).cast("double").alias("vwap"))
    ref = market.market_reference(prices, ASOF, 1 << 30, "symbol_id").select("symbol_id", F.col("ref_price").alias("ref"))  # the median of all days
    flags = audit.price_flags(F.col("price"), F.lit(None).cast("double"), F.col("ref"))
    return tx.join(ref, "symbol_id").groupBy("symbol_id").agg(F.count_if(flags["price_deviation_vs_market"]).alias("n_market"), F.count_if(flags["possible_zero_missing"]).alias("n_zero"), F.count("*").alias("n"))


_HOLDINGS = """SELECT filing_id, sum(CASE type WHEN 'buy' THEN amount WHEN 'sell' THEN -amount ELSE 0 END) AS net_signed, 1000 + filing_id % 500 AS holding_before, 1000 + filing_id % 500 + sum(CASE type WHEN 'buy' THEN amount WHEN 'sell' THEN -amount ELSE 0 END) AS holding_after,
 CAST(CAST(filing_id % 61 AS DECIMAL(18,3)) + 0.125 AS DOUBLE) AS share_percentage_before, CAST(CAST(filing_id % 59 AS DECIMAL(18,3)) + 0.250 AS DOUBLE) AS share_percentage_after FROM tx GROUP BY filing_id"""


def _holdings(tx: DataFrame) -> DataFrame:
    f = F.col("filing_id")
    net = tx.groupBy("filing_id").agg(F.sum(positions.signed_amount()).alias("net_signed"))
    return net.select("filing_id", "net_signed", (1000 + f % 500).alias("holding_before"), (1000 + f % 500 + F.col("net_signed")).alias("holding_after"), (f % 61 + 0.125).cast("double").alias("share_percentage_before"), (f % 59 + 0.25).cast("double").alias("share_percentage_after"))


@query(f"""WITH {TX}, h AS ({_HOLDINGS}), t AS (SELECT *, CASE WHEN share_percentage_before > 0 THEN holding_before / (share_percentage_before / 100.0) END AS total FROM h),
 d AS (SELECT *, floor(net_signed / total * 100.0 * 1000) / 1000 AS delta FROM t)
 SELECT filing_id, round(total, 4) AS total_shares_model, abs(delta + share_percentage_before - share_percentage_after) > 0.25 AS percent_discrepancy FROM d""")
def percent_model_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.percent_model(_holdings(transactions(spark, sf_dir))).select("filing_id", F.round("total_shares_model", 4).alias("total_shares_model"), "percent_discrepancy")


@query(f"""WITH g AS (SELECT p_partkey, max(CAST(l_shipdate AS DATE)) AS d FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey)
 SELECT p_partkey AS symbol, d AS asof_date, coalesce(abs(date_diff('day', d, DATE '{ASOF}')) > 14, false) AS stale_price, d IS NULL AS missing_price FROM g""")
def stale_missing_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = market.market_reference(_prices(spark, sf_dir), ASOF, 20, "symbol", ("date", *ORDER))
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("symbol")).join(ref, "symbol", "left")
    one = F.array(F.struct(F.lit("2024-01-02").alias("date"), F.lit("buy").alias("type"), F.lit(1.0).alias("price"), F.lit(1).cast("long").alias("amount")))
    rows = rows.withColumns({"txs": one, "transaction_type": F.lit("buy"), **{c: F.lit(1) for c in ("amount_transaction", "holding_before", "holding_after", "price", "transaction_value")}})
    codes = F.transform(audit.row_reasons(brief=True), lambda r: r["code"])
    return rows.select("symbol", "asof_date", F.array_contains(codes, "stale_price").alias("stale_price"), F.array_contains(codes, "missing_price").alias("missing_price"))


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings with holdings, medians, references and their reasons; one shuffle on the filing, one on the symbol."""
    tx = transactions(spark, sf_dir, *ORDER)
    ref = tx.groupBy("symbol_id").agg(F.percentile("price", F.lit(0.5)).alias("ref"))
    one = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), "type", "price", "amount")
    doc = tx.groupBy("filing_id").agg(F.percentile("price", F.lit(0.5)).alias("doc_median"), F.sum(positions.signed_amount()).alias("net_signed"), F.sum("amount").alias("amount_transaction"), F.sum("value").cast("double").alias("transaction_value"), F.min_by("symbol_id", F.struct(*ORDER)).alias("symbol_id"), F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, one.alias("tx")))), lambda s: s["tx"]).alias("txs"))
    f = F.col("filing_id")
    doc = doc.withColumns({"price": F.col("transaction_value") / F.col("amount_transaction"), "holding_before": 1000 + f % 500, "holding_after": 1000 + f % 500 + F.col("net_signed"), "share_percentage_before": (f % 61 + 0.125).cast("double"), "share_percentage_after": (f % 59 + 0.25).cast("double"), "transaction_type": F.when(f % 2 == 0, "buy").otherwise("sell"), "freshness_days": (f % 30).cast("int")})
    rows = doc.join(ref.withColumnRenamed("ref", "ref_price"), "symbol_id", "left")
    return audit.audit(positions.percent_model(rows), brief=True)


_AUDITED = f"""{TX}, ref AS (SELECT symbol_id, median(price) AS ref FROM tx GROUP BY symbol_id),
 h AS ({_HOLDINGS}), m AS (SELECT filing_id, median(price) AS med, arg_min(symbol_id, ({', '.join(ORDER)})) AS sid, bool_or(type IN ('buy','sell')) AS trades, bool_or(type NOT IN ('buy','sell')) AS others FROM tx GROUP BY filing_id),
 f AS (SELECT h.*, med, ref, trades, others, filing_id % 30 AS fresh, CASE WHEN filing_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS tt, holding_before / (share_percentage_before / 100.0) AS total FROM h JOIN m USING (filing_id) LEFT JOIN ref ON ref.symbol_id = m.sid),
 r AS (SELECT filing_id, 'stale_price' AS code, 1 AS n FROM f WHERE fresh > 14
 UNION ALL SELECT filing_id, 'mismatch_transaction_type', 1 FROM f WHERE (tt = 'buy' AND holding_after + 0.001 < holding_before) OR (tt = 'sell' AND holding_after > holding_before + 0.001)
 UNION ALL SELECT filing_id, 'mixed_transaction_type', 1 FROM f WHERE trades AND others
 UNION ALL SELECT filing_id, 'price_deviation_within_doc', count(*) FROM tx JOIN f USING (filing_id) WHERE price / med < 0.5 OR price / med > 1.5 GROUP BY filing_id
 UNION ALL SELECT filing_id, 'price_deviation_vs_market', count(*) FROM tx JOIN f USING (filing_id) WHERE price / ref < 0.6 OR price / ref > 1.4 GROUP BY filing_id
 UNION ALL SELECT filing_id, 'possible_zero_missing', count(*) FROM tx JOIN f USING (filing_id) WHERE price / ref BETWEEN 8 AND 15 OR price / ref BETWEEN 80 AND 150 GROUP BY filing_id
 UNION ALL SELECT filing_id, 'percent_discrepancy', 1 FROM f WHERE abs(floor(net_signed / total * 100.0 * 1000) / 1000 + share_percentage_before - share_percentage_after) > 0.25)"""


@query(f"""WITH {_AUDITED} SELECT code, sum(n)::BIGINT AS n_reasons, count(*) AS n_filings FROM r GROUP BY code""")
def reasons_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = audit.by_code(audited(spark, sf_dir), "filing_id")
    return each.groupBy("code").agg(F.sum("n").alias("n_reasons"), F.count("*").alias("n_filings"))


@query(f"""WITH {_AUDITED}, g AS (SELECT filing_id, CASE WHEN trades AND others THEN 'mixed_transaction_type' WHEN fresh > 14 THEN 'stale_price' WHEN EXISTS (SELECT 1 FROM r WHERE r.filing_id = f.filing_id AND code = 'percent_discrepancy') THEN 'percent_discrepancy'
 WHEN EXISTS (SELECT 1 FROM r WHERE r.filing_id = f.filing_id AND code IN ('price_deviation_within_doc','price_deviation_vs_market','possible_zero_missing')) THEN 'suspicious_price_level' END AS skip_reason FROM f)
 SELECT skip_reason IS NOT NULL AS needs_review, skip_reason, count(*) AS n FROM g GROUP BY skip_reason""")
def gate_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir).groupBy("needs_review", "skip_reason").agg(F.count("*").alias("n"))


@query(f"""WITH {TX}, m AS (SELECT filing_id, median(price) AS med FROM tx GROUP BY filing_id), ref AS (SELECT symbol_id, median(price) AS ref FROM tx GROUP BY symbol_id),
 f AS (SELECT filing_id, CAST(sum(value) AS DOUBLE) AS total_value, count(*) FILTER (price / med < 0.5 OR price / med > 1.5) AS n_doc, count(*) FILTER (price / ref < 0.6 OR price / ref > 1.4) AS n_market, count(*) FILTER (price / ref BETWEEN 8 AND 15 OR price / ref BETWEEN 80 AND 150) AS n_zero FROM tx JOIN m USING (filing_id) JOIN ref USING (symbol_id) GROUP BY filing_id)
 SELECT f.*, o_custkey AS holder_id, CAST(o_orderdate AS DATE) AS day FROM f JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) o ON o_orderkey = filing_id AND rn = 1 ORDER BY total_value DESC, filing_id LIMIT 20""")
def filing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: medians, references and price rules of each filing, one filing a holder and day, the 20 largest."""
    tx = transactions(spark, sf_dir)
    med = positions.document_median(tx, "filing_id")
    ref = tx.groupBy("symbol_id").agg(F.percentile("price", F.lit(0.5)).alias("ref"))
    flags = audit.price_flags(F.col("price"), F.col("doc_median"), F.col("ref"))
    rows = tx.join(ref, "symbol_id").join(med, "filing_id").groupBy("filing_id").agg(F.sum("value").cast("double").alias("total_value"), F.count_if(flags["price_deviation_within_doc"]).alias("n_doc"), F.count_if(flags["price_deviation_vs_market"]).alias("n_market"), F.count_if(flags["possible_zero_missing"]).alias("n_zero"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filing_id"), F.col("o_custkey").alias("holder_id"), F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    first = orders.groupBy("holder_id", "day").agg(F.min(F.struct(-F.col("o_totalprice"), F.col("filing_id").alias("filing_id")))["filing_id"].alias("filing_id"))
    return rows.join(first, "filing_id").orderBy(F.desc("total_value"), "filing_id").limit(20)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name AS company_name, lower(regexp_replace(n_name, '[^A-Za-z0-9]+', '-', 'g')) AS sector, coalesce(lower(regexp_replace(r_name, '[^A-Za-z0-9]+', '-', 'g')), 'unknown') AS sub_sector
 FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def company_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    dim = dim.select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".JK")).alias("symbol"), F.col("s_name").alias("company_name"), "n_name", "r_name")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct().withColumn("symbol", F.col("l_suppkey").cast("string"))
    got = lookup.company_join(rows, dim)
    return got.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "company_name", lookup.enriched_sector(F.lit(None).cast("string"), F.col("n_name")).alias("sector"), lookup.enriched_sector(F.lit(None).cast("string"), F.col("r_name")).alias("sub_sector"))


@query("""SELECT l_orderkey, max(l_quantity) AS q, CASE WHEN count(*) % 2 = 0 THEN min(l_extendedprice) END AS p, bool_or((l_discount * 1000 < 50 AND l_tax * 1000 >= 50) OR (l_discount * 1000 >= 50 AND l_tax * 1000 < 50)) AS takeover, bool_or((l_discount * 1000 < 50 AND l_tax * 1000 > 50) OR (l_discount * 1000 > 50 AND l_tax * 1000 < 50)) AS takeover_strict FROM lineitem GROUP BY l_orderkey""")
def takeover_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import tags

    b, a = F.col("l_discount") * 1000, F.col("l_tax") * 1000
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_quantity").alias("q"), F.when(F.count("*") % 2 == 0, F.min("l_extendedprice")).alias("p"), F.max(tags.crosses_half(b, a)).alias("takeover"), F.max(tags.crosses_half_strictly(b, a)).alias("takeover_strict"))


@query("""SELECT sha256(string_agg(line, chr(10) ORDER BY line)) AS checksum, count(*) AS row_count FROM (SELECT n_nationkey || '|' || n_name || '|' || n_regionkey AS line FROM nation)""")
def checksum_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.checksum(read(spark, sf_dir, "nation"), "n_nationkey", "n_name", "n_regionkey")


@query("""WITH p AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = (SELECT min(event_type) FROM events)), e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = (SELECT max(event_type) FROM events))
 SELECT e.event_id, e.user_id, p.value AS last_value FROM e ASOF LEFT JOIN (SELECT user_id, ts, arg_max(value, event_id) AS value FROM p GROUP BY user_id, ts) p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def asof_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension: each event of one type with the latest value of another type of the same user."""
    ev = read(spark, sf_dir, "events")
    lo, hi = ev.agg(F.min("event_type"), F.max("event_type")).first()
    right = ev.where(F.col("event_type") == lo).groupBy("user_id", "ts").agg(F.max_by("value", "event_id").alias("last_value"))
    left = ev.where(F.col("event_type") == hi).select("event_id", "user_id", "ts")
    return market.asof_join(left, right, "user_id", "ts", "last_value").select("event_id", "user_id", "last_value")


@query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS raw, round(o_totalprice, 2) AS n_dot, CAST(floor(o_totalprice) AS DOUBLE) AS n_group, floor(CAST(o_totalprice AS DECIMAL(18,2)) * 100000 / 1000000) / 100000 AS pct FROM orders""")
def locale_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("raw", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    european = F.translate(F.format_string("%,.2f", F.col("o_totalprice")), ",.", ".,")
    whole = F.translate(F.format_string("%,d", F.floor("o_totalprice")), ",", ".")
    pct = F.concat(F.replace((F.col("o_totalprice").cast("decimal(18,2)") / 1000000).cast("decimal(28,12)").cast("string"), F.lit("."), F.lit(",")), F.lit(" %"))
    return o.select("o_orderkey", "raw", numbers.locale_number(european).alias("n_dot"), numbers.locale_number(F.when(F.col("o_totalprice") >= 1000, whole).otherwise(F.floor("o_totalprice").cast("string"))).alias("n_group"), numbers.locale_percent(pct).alias("pct"))
