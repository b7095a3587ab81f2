"""Canonical filing records from parsed rows: one projection over a JSON column, joins for documents and companies.

The row's JSON stays text and its fields are taken from one variant, so any extra
field is carried along unread. Fields are picked as the parsers name them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import once, parse_transactions, string_list
from ..functions.numbers import floor_places, to_double, to_long
from ..functions.text import blank_to_null, is_url, lowered, symbol
from . import articles, lookup, tags

# English of stated purposes, asked in this order. Phrases and words that a text has, then tags.
PURPOSE_PHRASES = {
    "memperluas basis kepemilikan saham": "expanding the shareholder base",
    "memperluas basis kepemilikan": "expanding the shareholder base",
    "investasi lainnya": "other investment",
    "investasi lain": "other investment",
    "transaksi pribadi": "personal transaction",
    "transaksi pribadi/investasi": "personal investment transaction",
    "kepemilikan pribadi/individu/investasi": "personal / individual investment ownership",
    "kepemilikan pribadi/individu": "personal or individual ownership",
    "kepemilikan pribadi": "personal ownership",
    "pembayaran utang": "debt repayment",
    "pembayaran hutang": "debt repayment",
    "pembayaran pinjaman": "loan repayment",
}
PURPOSE_WORDS = {
    "bagian dari proses akuisisi": "part of the acquisition process",
    "strategi internal": "internal strategy",
    "pengembangan usaha": "business expansion",
    "investasi": "investment",
    "divestasi": "divestment",
    "sesuai surat pemberitahuan dari": "in accordance with the notification letter",
    "surat pemberitahuan": "in accordance with the notification letter",
    "investation": "investment",
}
PURPOSE_TAGS = {
    "akuisisi": "takeover", "acquisition": "takeover", "strategi internal": "internal-strategy", "internal strategy": "internal-strategy",
    "pengembangan usaha": "internal-strategy", "business expansion": "internal-strategy", "mesop": "mesop", "warisan": "inheritance",
    "inheritance": "inheritance", "penghargaan": "award", "award": "award", "transfer": "share-transfer", "investasi": "investment",
    "investment": "investment", "divestasi": "divestment", "difvestment": "divestment",
}


def english_purpose(text: Column) -> Column:
    """English of a stated purpose (R18): the first phrase it has, the word that it is, the first word it has, the first tag's name, else itself."""
    low = F.trim(lowered(text))
    first = lambda bank, t: F.coalesce(*[F.when(t.contains(k), v) for k, v in bank.items()])
    whole = lambda t: F.coalesce(*[F.when(t == k, v) for k, v in PURPOSE_WORDS.items()])
    spoken = {k: v.replace("-", " ") for k, v in PURPOSE_TAGS.items()}
    return F.coalesce(once(low, lambda t: F.coalesce(first(PURPOSE_PHRASES, t), whole(t), first(PURPOSE_WORDS, t), first(spoken, t))), text)


def iso_time(x: Column) -> Column:
    """ISO date and time of YYYYMMDD or ISO-like text, a space for T allowed; null if it is neither."""
    def plain(t: Column) -> Column:
        return F.when(t.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2))).otherwise(F.replace(t, F.lit(" "), F.lit("T")))

    def full(t: Column) -> Column:
        return F.when(F.length(t) == 10, F.concat(t, F.lit("T00:00:00"))).when(t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$"), F.concat(t, F.lit(":00"))).otherwise(t)

    def valid(t: Column) -> Column:
        return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}") & t.try_cast("timestamp_ntz").isNotNull(), t)

    return once(once(once(F.trim(x), plain), full), valid)


def _listed(v: Column, path: str) -> Column:
    """Transactions of a list of objects; a type that is missing stays so."""
    one = lambda o, *names: F.coalesce(*[blank_to_null(F.try_variant_get(o, f"$.{k}", "string")) for k in names])
    return F.transform(
        F.try_variant_get(v, path, "array<variant>"),
        lambda o: F.struct(one(o, "date_iso", "date").alias("date"), one(o, "type").alias("type"), to_double(one(o, "price")).alias("price"), to_long(F.coalesce(F.nullif(one(o, "amount"), F.lit("0")), one(o, "amount_transacted"))).alias("amount")),
    )


def _transactions(v: Column, published: Column) -> Column:
    """Transactions of a parsed row, lists before blocks of parallel arrays; their date is ISO, else the day of publication."""
    block = F.transform(parse_transactions(F.try_variant_get(v, "$.price_transaction", "string")), lambda t: t.withField("date", F.lit(None).cast("string")))
    some = F.coalesce(_listed(v, "$.transactions"), _listed(v, "$.price_transaction"), block, F.array().cast("array<struct<date:string,type:string,price:double,amount:bigint>>"))
    return F.transform(some, lambda t: t.withField("date", F.substring(iso_time(F.coalesce(t["date"], published)), 1, 10)))


def _total(txs: Column, value) -> Column:
    """Sum over buys and sells with a price and an amount above zero; null without such."""
    good = F.filter(txs, lambda t: F.lower(t["type"]).isin("buy", "sell") & (t["price"] > 0) & (t["amount"] > 0))
    return F.when(F.size(good) > 0, F.aggregate(good, F.lit(0.0), lambda s, t: s + value(t)))


def canonical_records(rows: DataFrame, raw: str = "raw", documents: DataFrame | None = None, companies: DataFrame | None = None, translate: Callable[[Column], Column] = english_purpose) -> DataFrame:
    """Canonical records of parsed rows (JSON text in `raw`); other columns stay in front.

    `documents` has `main_link`, `filename` and `date` of announcements: rows whose
    source is a file name get link and date by any alias of it, and rows whose
    source is a link keep it and get the date. `companies` has `symbol, sector,
    sub_sector`. Explicit numbers win over those of the transactions; percents are
    floored to three decimals. `needs_manual_uid` marks transfers and others. A
    text that is no JSON object gives a record of defaults.
    """
    names = [c for c in rows.columns if c != raw]
    base = rows.withColumn("__v", F.try_parse_json(raw))
    v = F.col("__v")
    text = lambda *keys: F.coalesce(*[blank_to_null(F.try_variant_get(v, f"$.{k}", "string")) for k in keys])
    real = lambda *keys: F.coalesce(*[F.nullif(text(k), F.lit("0")) for k in keys])
    base = base.withColumns({"__source": text("source", "pdf_path", "file", "filename"), "__symbol": symbol(text("symbol", "issuer_code"))})
    if documents is not None:
        every = documents.select(F.explode(F.array("main_link", "filename")).alias("name"), F.col("main_link").alias("__link"), F.col("date").alias("__date"))
        index = lookup.alias_index(every.withColumn("__seq", F.struct("__date", "__link")), "name", "__seq").select("alias", "__link", "__date")
        sources = base.select("__source").where("__source is not null").distinct()
        base = base.join(lookup.alias_join(sources, "__source", ["__source"], index, ["__link", "__date"]), "__source", "left")
    else:
        base = base.withColumns({"__link": F.lit(None).cast("string"), "__date": F.lit(None).cast("string")})
    if companies is not None:
        known = companies.select("symbol", F.col("sector").alias("__sector"), F.col("sub_sector").alias("__sub"))
        base = lookup.company_join(base, known, "__symbol")
    else:
        base = base.withColumns({"__sector": F.lit(None).cast("string"), "__sub": F.lit(None).cast("string")})
    first_date = F.try_variant_get(v, "$.transactions[0].date", "string")
    base = base.withColumn("__when", F.coalesce("__date", text("timestamp", "announcement_published_at", "date"), first_date))
    base = base.withColumn("__txs", _transactions(v, F.col("__when")))
    txs = F.col("__txs")
    base = base.withColumns({"__shares": _total(txs, lambda t: t["amount"].cast("double")), "__value": _total(txs, lambda t: t["price"] * t["amount"]), "holding_before": to_long(text("holding_before")), "holding_after": to_long(text("holding_after"))})
    base = base.withColumns({
        "transaction_type": tags.record_type(F.coalesce(text("transaction_type", "type"), F.lit("")), F.col("holding_before"), F.col("holding_after")),
        "amount_transaction": F.coalesce(to_long(F.coalesce(real("amount_transaction"), text("amount"))), F.col("__shares").cast("long")),
        "price": F.coalesce(to_double(text("price")), F.try_divide("__value", "__shares")),
        "holder_name": F.coalesce(text("holder_name"), F.lit("Unknown Shareholder")),
        "company_name": F.coalesce(text("company_name_raw", "company_name", "symbol"), F.lit("Unknown Company")),
        "purpose_of_transaction": translate(text("purpose", "purpose_of_transaction")),
    })
    value = F.coalesce(to_double(text("transaction_value")), F.col("__value"), F.col("price") * F.col("amount_transaction"))
    kind = F.col("transaction_type")
    words = articles.title_and_body(F.col("holder_name"), F.col("company_name"), kind, F.col("amount_transaction"), F.col("holding_before"), F.col("holding_after"), F.col("purpose_of_transaction"))
    base = base.withColumns({"transaction_value": value, "__words": words})
    percent = lambda k: floor_places(text(k)).alias(k)
    link = F.when(is_url(F.col("__source")), F.col("__source")).otherwise(F.coalesce("__link", text("pdf_url", "original_url", "url", "main_link", "link")))
    return base.select(
        *names, F.col("__symbol").alias("symbol"), iso_time(F.col("__when")).alias("timestamp"), "transaction_type", "holder_name", "company_name", "holding_before", "holding_after", "amount_transaction",
        percent("share_percentage_before"), percent("share_percentage_after"), percent("share_percentage_transaction"), "price", "transaction_value",
        F.col("__words.title").alias("title"), F.col("__words.body").alias("body"), "purpose_of_transaction",
        F.transform("__txs", lambda t: F.struct(t["date"].alias("date"), t["type"].alias("type"), t["price"].alias("price"), t["amount"].alias("amount_transacted"))).alias("price_transaction"),
        tags.record_tags(string_list(F.try_variant_get(v, "$.tags", "string")), kind).alias("tags"),
        lookup.enriched_sector(text("sector"), F.col("__sector")).alias("sector"), lookup.enriched_sector(text("sub_sector"), F.col("__sub")).alias("sub_sector"),
        link.alias("source"), text("holder_type").alias("holder_type"), kind.isin("share-transfer", "other", "others").alias("needs_manual_uid"),
    )
