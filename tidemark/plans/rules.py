"""Queries over records, stored shapes, filters and the audit rules that ordinary filings don't set off."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, dates, numbers
from ..operators import alerts, articles, audit, filters, forms, lookup, records, tags
from .tables import read

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey AS b, c_name AS h, o_orderdate AS d, o_orderkey % 30 AS n, CASE o_orderkey % 4 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' WHEN 2 THEN 'share-transfer' ELSE CASE WHEN o_orderkey > o_custkey THEN 'buy' WHEN o_orderkey < o_custkey THEN 'sell' ELSE 'others' END END AS t,
 CAST(CASE WHEN o_orderkey % 5 = 1 THEN 1234 ELSE (o_orderkey % 9 + 1) * 100 END AS BIGINT) AS a, CAST(o_orderkey % 50 + 1 AS DOUBLE) AS p FROM orders JOIN customer ON o_custkey = c_custkey)
 SELECT k AS o_orderkey, 'N' || (b % 30) || '.JK' AS symbol, CASE WHEN n < 25 THEN '2024-01-' || lpad(CAST(n + 1 AS VARCHAR), 2, '0') || 'T08:00:00' ELSE strftime(d, '%Y-%m-%dT%H:%M:%S') END AS timestamp, t AS transaction_type, b AS holding_before, k AS holding_after, a AS amount_transaction, p AS price,
 p * (k % 9 + 1) * 100 AS transaction_value, CASE t WHEN 'buy' THEN h || ' buys shares of Issuer' WHEN 'sell' THEN h || ' sells shares of Issuer' WHEN 'share-transfer' THEN h || ' transfers shares of Issuer' ELSE 'Change in ' || h || '''s position in Issuer' END AS title,
 CASE k % 3 WHEN 0 THEN 'other investment' WHEN 1 THEN 'takeover' ELSE 'beli' END AS purpose_of_transaction, coalesce(lower(regexp_replace(n_name, '[^A-Za-z0-9]+', '-', 'g')), 'unknown') AS sector, CASE WHEN n < 25 THEN 'https://files.example.org/doc-' || n || '.pdf' END AS source, t IN ('share-transfer', 'others') AS needs_manual_uid,
 strftime(d, '%Y-%m-%d') AS first_date, CASE WHEN n < 25 THEN '2024-01-' || lpad(CAST(n + 1 AS VARCHAR), 2, '0') ELSE strftime(d, '%Y-%m-%d') END AS second_date, list_sort(list_distinct(list_filter(['investment', CASE WHEN t = 'share-transfer' THEN t END], lambda x: x IS NOT NULL))) AS tags FROM o LEFT JOIN nation ON n_nationkey = b % 30""")
def canonical_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed rows in JSON to records, with documents and companies looked up."""
    nation, k = read(spark, sf_dir, "nation"), F.col("o_orderkey")
    text = lambda c: c.cast("string")
    docs = nation.select(F.concat(F.lit("https://files.example.org/doc-"), text(F.col("n_nationkey")), F.lit(".pdf")).alias("main_link"), F.concat(F.lit("doc-"), text(F.col("n_nationkey")), F.lit(".pdf")).alias("filename"), F.concat(F.lit("2024-01-"), F.lpad(text(F.col("n_nationkey") + 1), 2, "0"), F.lit("T08:00:00")).alias("date"))
    companies = nation.select(F.concat(F.lit("N"), text(F.col("n_nationkey"))).alias("symbol"), F.col("n_name").alias("sector"), F.lit(None).cast("string").alias("sub_sector"))
    first = F.struct(F.lit("Buy").alias("type"), ((k % 9 + 1) * 100).alias("amount_transacted"), (k % 50 + 1).alias("price"), F.date_format("o_orderdate", "yyyyMMdd").alias("date"))
    second = F.struct(F.lit("transfer").alias("type"), F.lit(5).cast("long").alias("amount_transacted"), F.lit(1).cast("long").alias("price"), F.lit(None).cast("string").alias("date"))
    raw = F.struct(
        F.col("o_custkey").alias("holding_before"), k.alias("holding_after"), F.when(k % 4 == 0, "buy").when(k % 4 == 1, " SELL").when(k % 4 == 2, "share-transfer").alias("transaction_type"),
        F.array(first, second).alias("price_transaction"), F.when(k % 5 == 1, "1,234").when(k % 5 == 0, "0").alias("amount_transaction"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(k % 3 == 0, "Investasi Lainnya").when(k % 3 == 1, "Akuisisi perusahaan").otherwise("beli").alias("purpose"), F.concat(F.lit("in/doc-"), text(k % 30), F.lit(".pdf")).alias("source"),
        F.concat(F.lit("n"), text(F.col("o_custkey") % 30)).alias("symbol"), F.lit("Issuer").alias("company_name"), F.col("c_name").alias("holder_name"), F.array(F.lit("Investment"), F.lit("rumour")).alias("tags"),
    )
    rows = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.to_json(raw).alias("raw"))
    got = records.canonical_records(rows, documents=docs, companies=companies)
    return got.select("o_orderkey", "symbol", "timestamp", "transaction_type", "holding_before", "holding_after", "amount_transaction", "price", "transaction_value", "title", "purpose_of_transaction", "sector", "source", "needs_manual_uid", F.col("price_transaction")[0]["date"].alias("first_date"), F.col("price_transaction")[1]["date"].alias("second_date"), "tags")


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 8 AS m FROM orders), c AS (SELECT k, list_filter([CASE WHEN m = 1 THEN 'missing_price' END, CASE WHEN m = 2 THEN 'missing_required_field' END, CASE WHEN m = 2 THEN 'mismatch_transaction_type' END, CASE WHEN m = 3 THEN 'transfer_only_transaction' END, CASE WHEN m = 4 THEN 'mixed_transaction_type' END, CASE WHEN m IN (5, 6) THEN 'invalid_price_transaction' END, CASE WHEN m = 7 THEN 'price_deviation_within_doc' END, CASE WHEN m = 7 THEN 'possible_zero_missing' END], lambda x: x IS NOT NULL) AS codes, m FROM o)
 SELECT k AS o_orderkey, codes, CASE m WHEN 3 THEN 'transfer_only_transaction' WHEN 4 THEN 'mixed_transaction_type' WHEN 1 THEN 'missing_price' WHEN 7 THEN 'suspicious_price_level' END AS skip_reason, m IN (1, 3, 4, 7) AS needs_review, CASE WHEN m = 2 THEN 'missing: holding_before, price' END AS said, CASE WHEN m = 7 THEN '10.000' END AS ratio FROM c""")
def audit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order in eight breaks each rule: no price, no field, transfers alone, a mix, no date, no transactions, a price ten times too high."""
    k = F.col("o_orderkey")
    m = k % 8
    tx = lambda kind, price=100.0, date="2024-01-02": F.struct(F.lit(date).cast("string").alias("date"), F.lit(kind).alias("type"), F.lit(price).alias("price"), F.lit(10).cast("long").alias("amount"))
    txs = F.when(m == 3, F.array(tx("transfer"), tx("other"))).when(m == 4, F.array(tx("buy"), tx("transfer"))).when(m == 5, F.array(tx("buy", date=None))).when(m == 6, F.array().cast("array<struct<date:string,type:string,price:double,amount:bigint>>")).when(m == 7, F.array(tx("buy"), tx("buy", 1000.0))).otherwise(F.array(tx("buy")))
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", txs.alias("txs"), F.lit(1).alias("freshness_days"), F.when(m == 7, 0.0).when(m != 1, 100.0).alias("ref_price"), F.lit(100.0).alias("doc_median"), F.lit(10).cast("long").alias("amount_transaction"),
        F.when(m != 2, 100).cast("long").alias("holding_before"), F.lit(110).cast("long").alias("holding_after"), F.when(m != 2, 100.0).alias("price"), F.lit(1000.0).alias("transaction_value"), F.lit("buy").alias("transaction_type"), F.lit(False).alias("percent_discrepancy"), F.lit(0.0).alias("discrepancy_pp"),
    )
    got = audit.audit(rows)
    of = lambda code: F.get(F.filter("reasons", lambda r: r["code"] == code), F.lit(0))
    return got.select("o_orderkey", F.transform("reasons", lambda r: r["code"]).alias("codes"), "skip_reason", "needs_review", of("missing_required_field")["message"].alias("said"), of("possible_zero_missing")["details"]["ratio"].cast("decimal(20,3)").cast("string").alias("ratio"))


@query("""SELECT c_custkey, round(c_acctbal, 2) AS plain, CAST(trunc(c_acctbal) AS BIGINT) AS dotted, CAST(c_custkey * 1000 AS BIGINT) AS grouped, CASE WHEN c_custkey % 3 = 0 THEN '0' ELSE CAST(c_custkey AS VARCHAR) END AS dash, CAST(c_custkey AS VARCHAR) || '.5000000000' AS same_key, c_custkey % 2 = 0 AS near FROM customer""")
def number_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, k = F.col("c_acctbal"), F.col("c_custkey")
    euro = F.translate(F.format_string("%,.2f", b), ",.", ".,")
    thousands = F.format_string("%,d", k * 1000)
    grouped = F.when(k == 0, "0").when(k % 2 == 0, thousands).otherwise(F.translate(thousands, ",", "."))
    dash = numbers.dash_is_zero(F.when(k % 3 == 0, F.lit(" – ")).otherwise(k.cast("string")))
    half = F.concat(k.cast("string"), F.lit(".50"))
    return read(spark, sf_dir, "customer").select("c_custkey", numbers.to_double(F.format_string(" %,.2f", b)).alias("plain"), numbers.dotted_number(euro).alias("dotted"), numbers.grouped_int(grouped).alias("grouped"), dash.alias("dash"), numbers.key_number(half).cast("string").alias("same_key"), numbers.close_percent(half, F.when(k % 2 == 0, F.concat(half, F.lit("00001"))).otherwise(F.concat(half, F.lit("1")))).alias("near"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS iso, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+07:00') END AS zoned, CAST(o_orderdate + INTERVAL 30 SECOND - INTERVAL 30 SECOND AS TIMESTAMP) AS minute FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-05 09:00:00' AND TIMESTAMP '1998-02-28 23:59:59'""")
def date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compact and ISO dates, offsets, minutes, within a day's window to the last second of the month after."""
    d = F.col("o_orderdate")
    lo, _ = dates.day_window("19980105", "09:00", "17:00")
    _, hi = dates.month_range("199802")
    rows = read(spark, sf_dir, "orders").where((d >= F.lit(lo).cast("timestamp_ntz")) & (d <= F.lit(f"{hi}T23:59:59").cast("timestamp_ntz")))
    local = F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")
    zoned = F.when(F.col("o_orderkey") % 2 == 0, local).otherwise(F.concat(local, F.lit("+07:00")))
    return rows.select("o_orderkey", dates.iso_date(F.date_format(d, "yyyyMMdd")).alias("compact"), dates.iso_date(F.concat(F.lit(" "), local)).alias("iso"), dates.with_z(zoned).alias("zoned"), dates.to_minute(d + F.expr("INTERVAL 30 SECOND")).alias("minute"))


@query("""SELECT o_orderkey, 2 AS n, 'buy' AS first_type, CASE o_orderkey % 3 WHEN 0 THEN 'transfer' ELSE 'other' END AS second_type, 'other' AS second_kind, CAST(o_orderkey % 50 + 1 AS DOUBLE) AS price, CAST(o_orderkey AS BIGINT) AS amount, CASE WHEN o_orderkey % 3 = 0 THEN '2024-02-02' ELSE '2024-01-02' END AS date, o_orderpriority AS name, ['a b', 'c'] AS list, 'behind' || chr(10) || o_orderkey AS rest FROM orders""")
def stored_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two transactions as a list of objects, as a block of parallel arrays, and as such a block in a list."""
    k = F.col("o_orderkey")
    js = lambda c: c.cast("string")
    price, amount = js(k % 50 + 1), js(k)
    objects = F.concat(F.lit('[{"type":"buy","price":'), price, F.lit(',"amount":'), amount, F.lit(',"date":"2024-02-02"},{"type":"transfer","price":1,"amount_transacted":2}]'))
    block = F.concat(F.lit('{"type":["buy"],"prices":['), price, F.lit(',1],"amount_transacted":['), amount, F.lit(",2]}"))
    raw = F.when(k % 3 == 0, objects).when(k % 3 == 1, block).otherwise(F.concat(F.lit("["), F.replace(block, F.lit('"prices"'), F.lit('"price"')), F.lit("]")))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", arrays.parse_transactions(raw).alias("txs"))
    t = arrays.collapse(F.col("txs"), F.lit("2024-01-02"), F.lit("others"))
    name = F.when(k % 2 == 0, F.concat(F.lit("{'name': '"), F.col("o_orderpriority"), F.lit("'}"))).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority")))
    listed = F.when(k % 2 == 0, F.lit('["a b", " ", "c"]')).otherwise(F.lit(" a b,, c"))
    rest = forms.after_marker(F.concat(F.lit("head\nThe MARKER line\nbehind\n"), js(k)), "marker")
    return rows.select("o_orderkey", F.size(t).alias("n"), t[0]["type"].alias("first_type"), t[1]["type"].alias("second_type"), arrays.canonical_type(t[1]["type"]).alias("second_kind"), t[0]["price"].alias("price"), t[0]["amount_transacted"].alias("amount"), t[0]["date"].alias("date"), arrays.name_of(name).alias("name"), arrays.string_list(listed).alias("list"), rest.alias("rest"))


@query("""SELECT o_orderkey, o_orderkey % 3 = 0 AS tagged, o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 AS valid, CASE WHEN o_orderkey % 7 = 0 THEN 'needs_review' WHEN o_orderkey % 3 = 0 THEN 'stale_price' WHEN o_orderkey % 2 = 0 THEN 'suspicious' END AS held, CASE WHEN o_orderkey % 2 = 0 THEN 'idx' ELSE 'non-idx' END AS source_type, 'doc-' || o_orderkey || '.pdf' AS filename, list_sort(list_distinct(['takeover', CASE WHEN o_orderkey % 3 = 0 THEN 'share-transfer' ELSE 'takeover' END, CASE WHEN o_orderkey % 3 = 1 THEN 'award' ELSE 'takeover' END])) AS tags FROM orders WHERE o_orderkey % 11 <> 0""")
def filter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = filters.not_skipped(read(spark, sf_dir, "orders").withColumn("skip_reason", F.when(k % 11 == 0, "mixed_transaction_type").when(k % 11 == 1, "stale_price")))
    link = F.concat(F.when(k % 2 == 0, "https://www.IDX.co.id/a/doc-").otherwise("https://example.org/doc-"), k.cast("string"), F.lit(".pdf"))
    block = filters.announcement_block(F.lit("t"), link, F.when(k % 3 == 0, "").when(k % 3 == 1, link))
    txs = F.when(k % 5 != 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    valid = filters.is_valid_row(F.lit(None).cast("boolean"), [F.when(k % 4 != 0, k), F.lit(0)], txs)
    held = alerts.gate_reason(k % 7 == 0, F.when(k % 3 == 0, F.array(F.lit("mixed"), F.lit("stale_price"))).otherwise(F.array(F.lit("mixed"))), {"suspicious": k % 2 == 0}, ["stale_price"])
    kind = F.when(k % 3 == 0, "share-transfer").when(k % 3 == 1, "Award").otherwise("mesops")
    return rows.select("o_orderkey", filters.has_any_tag(F.when(k % 3 == 0, F.array(F.lit("Insider-Trading"))).otherwise(F.array(F.lit("bank"))), ["insider"]).alias("tagged"), valid.alias("valid"), held.alias("held"), block["source_type"].alias("source_type"), block["filename"].alias("filename"), tags.record_tags(F.array(F.lit(" Takeover"), F.lit("other"), F.lit("share-transfer")), kind).alias("tags")).withColumn("tags", F.when(k % 3 == 0, F.col("tags")).otherwise(F.array_remove("tags", "share-transfer")))


@query("""SELECT page_id, url AS main_link, 1 AS attachment_count, 'notes.pdf' AS extra, 'ownership-report-no-' || page_id AS title_slug FROM pages WHERE page_id % 3 <> 0""")
def raw_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw announcements whose first attachment is a web address, with one more that is one and one that isn't."""
    one = lambda path, name: F.struct(path.alias("FullSavePath"), F.lit(name).cast("string").alias("OriginalFilename"))
    main = F.when(F.col("page_id") % 3 == 0, F.lit("local/file.pdf")).otherwise(F.col("url"))
    raw = read(spark, sf_dir, "pages").select(F.array(one(main, None), one(F.lit("https://example.org/notes.pdf"), "notes.pdf"), one(F.lit("ftp://x"), "x")).alias("Attachments"), F.concat(F.lit("Ownership Report, No. "), F.col("page_id").cast("string")).alias("Title"), F.col("page_id").alias("Code"), F.lit("2024-01-01").alias("PublishDate"))
    return filters.announcements(raw).select(F.col("company_name").alias("page_id"), "main_link", F.col("attachment_count").alias("attachment_count"), F.col("attachments")[0]["filename"].alias("extra"), "title_slug")


@query("""SELECT s_suppkey, 'SUP' || s_suppkey AS symbol, round(s_acctbal, 2) AS close FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'SUP' || s_suppkey || '.JK', round(s_acctbal, 2) FROM supplier WHERE s_suppkey % 2 = 1""")
def company_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices by symbol with or without its suffix on either side."""
    s = read(spark, sf_dir, "supplier")
    name = F.concat(F.lit("SUP"), F.col("s_suppkey").cast("string"))
    dim = s.select(F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lower(name), F.lit(".jk"))).otherwise(name).alias("symbol"), F.round("s_acctbal", 2).alias("close"))
    rows = s.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, name).otherwise(F.concat(name, F.lit(".JK"))).alias("symbol"))
    return lookup.company_join(rows, dim).select("s_suppkey", "symbol", "close")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'https://files.example.org/b' ELSE 'https://example.org/main' END AS url, o_orderkey % 4 = 1 AS mismatch, CASE o_orderkey % 5 WHEN 0 THEN 'Insert manually using the attached link, then re-run.' WHEN 1 THEN 'Fetch latest price data and re-run validation.' WHEN 2 THEN 'Pair both sides manually.' ELSE 'Review and re-run.' END AS action,
 CASE o_orderkey % 3 WHEN 0 THEN 'https://x.org/a.pdf' WHEN 1 THEN 'https://i.org/a.pdf' ELSE 'source' END AS link FROM orders""")
def document_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, symbol checks and actions of alerts about documents."""
    k = F.col("o_orderkey")
    att = F.array(F.struct(F.lit("A.pdf").alias("filename"), F.lit("").alias("url")), F.struct(F.lit("B.pdf ").alias("filename"), F.lit("https://files.example.org/b").alias("url")))
    name = F.when(k % 3 == 0, "b.PDF").when(k % 3 == 1, "a.pdf")
    code = F.when(k % 4 == 0, "abcd").when(k % 4 == 1, "ABCE").when(k % 4 == 2, "none of these")
    what = F.when(k % 5 == 1, "stale_price").when(k % 5 == 2, "transfer_uid_required").otherwise("symbol_unknown")
    stage = F.when(k % 5 == 0, "parser").otherwise("filings")
    own = F.when(k % 3 == 0, "https://x.org/a.pdf").otherwise("https://x.org/page")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", alerts.attachment_link(att, name, F.lit("https://example.org/main")).alias("url"), alerts.symbol_mismatch(F.lit("ABCD.JK"), code).alias("mismatch"),
        alerts.action(what, stage, F.lit("not_inserted")).alias("action"), articles.document_link(own, F.when(k % 3 == 1, "https://i.org/a.pdf").otherwise(""), F.lit("source")).alias("link"),
    )


@query("""SELECT o_orderkey, [o_custkey + 100, 1500, 2000] AS numbers, CASE o_orderkey % 3 WHEN 0 THEN 2 ELSE 1 END AS n_pairs, CASE o_orderkey % 3 WHEN 0 THEN 10.0 WHEN 1 THEN 3.0 ELSE 1.0 END AS first_price, list_sort(list_distinct(['AA', o_orderstatus, 'S' || (o_custkey % 10)])) AS symbols, '[{"type":"buy","count":' || o_orderkey || '},{"type":"sell","count":2}]' AS counts FROM orders""")
def article_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a text, prices and amounts of an article by what the row has, merged symbols and a multiset's text."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    say = F.concat(F.lit("sold "), (c + 100).cast("string"), F.lit(" of 99 lots, 1.500 and 2,000"))
    raw = F.when(k % 3 == 0, F.lit('{"prices":[10,0,20],"amount_transacted":[5,6,7]}'))
    lists = F.when(k % 3 == 1, F.array(F.lit(3.0), F.lit(4.0))), F.when(k % 3 == 1, F.array(F.lit(9).cast("long")))
    pairs = arrays.prices_and_amounts(raw, *lists, F.lit(1.0), F.lit(2).cast("long"))
    one = lambda kind, n: F.struct(F.lit(kind).alias("type"), n.cast("long").alias("count"))
    symbols = arrays.merged_symbols(F.array(F.lit(" aa"), F.lower("o_orderstatus")), F.array(F.concat(F.lit("s"), (c % 10).cast("string")), F.lit("")))
    return read(spark, sf_dir, "orders").select("o_orderkey", arrays.first_numbers(say).alias("numbers"), F.size(pairs).alias("n_pairs"), pairs[0]["price"].alias("first_price"), symbols.alias("symbols"), arrays.stable_json(F.array(one("sell", F.lit(2)), one("buy", k))).alias("counts"))


@query("""SELECT o_orderkey, 'ABCD.JK' AS symbol, 'Maju ' || o_orderstatus || ' Jaya Tbk' AS company_name, 'Budi PT ' || o_orderstatus AS holder, o_orderkey * 1000 AS holding_before, o_custkey AS holding_after, CAST(o_orderkey % 100 AS DOUBLE) + 0.125 AS share_percentage_before, 'Laporan Kepemilikan Efek' AS title, CASE WHEN o_orderkey % 2 = 0 THEN 'PT Biro' ELSE 'UNKNOWN' END AS reporter FROM orders""")
def form_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holder, issuer, holdings and voting rights of the form's head, title and registrar of the older one."""
    k, c, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    dotted = lambda x: F.concat(F.translate(F.format_string("%,d", x), ",", "."), F.lit(",00 Unit"))
    doc = F.concat_ws(
        "\n", F.lit("Laporan Kepemilikan Efek"), F.lit("Nama (sesuai SID)"), F.concat(F.lit(": BUDI pt "), st), F.lit("Nama Perusahaan Tbk"), F.concat(F.lit(": ABCD - Maju  "), st, F.lit("\nJaya Tbk, PT")),
        F.lit("Jumlah Saham Sebelum Transaksi"), F.concat(F.lit(": "), dotted(k * 1000)), F.lit("Hak Suara Sebelum Transaksi"), F.concat(F.lit(": "), (k % 100).cast("string"), F.lit(",1250%")), F.lit("Jumlah Saham Setelah Transaksi"), F.concat(F.lit(": "), dotted(c)), F.when(k % 2 == 0, "BAE : PT Biro"),
    )
    rows = read(spark, sf_dir, "orders").select("o_orderkey", doc.alias("text"))
    issuer, held, head = forms.form_issuer(F.col("text")), forms.form_holdings(F.col("text")), forms.title_and_reporter(F.col("text"))
    return rows.select("o_orderkey", issuer["symbol"].alias("symbol"), issuer["company_name"].alias("company_name"), forms.form_holder(F.col("text")).alias("holder"), held["holding_before"].alias("holding_before"), held["holding_after"].alias("holding_after"), held["share_percentage_before"].alias("share_percentage_before"), head["title"].alias("title"), head["reporter"].alias("reporter"))
