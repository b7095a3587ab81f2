"""Array and JSON expressions: the shapes in which transactions are stored."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TX = "struct<date:string,type:string,price:double,amount:bigint>"


def once(value: Column, body) -> Column:
    """`body` of a value that is made once a row, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical_type(x: Column) -> Column:
    """transfer, neutral and others are other."""
    t = F.lower(F.trim(x))
    return F.when(t.isin("transfer", "neutral", "others", "other"), "other").otherwise(t)


def zip_transactions(dates: Column, types: Column, prices: Column, amounts: Column, fill_type: str = "other") -> Column:
    """array<struct<date,type,price,amount>> of parallel arrays, as long as the longest; missing types are `fill_type`."""
    size = lambda a: F.coalesce(F.size(a), F.lit(0))
    n = F.greatest(*[F.when(a.isNull(), 0).otherwise(size(a)) for a in (dates, types, prices, amounts)])
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.get(dates, i).alias("date"), F.coalesce(F.get(types, i), F.lit(fill_type)).alias("type"), F.get(prices, i).alias("price"), F.get(amounts, i).alias("amount")))


def parse_transactions(raw: Column) -> Column:
    """Transactions of a JSON text in any stored shape (R1-R4, X27): a list of objects, one block of parallel arrays, such a block in a list; null if none fits.

    The text is parsed once and each array of a block is read once.
    """
    return once(F.try_parse_json(raw), lambda v: F.coalesce(once(_block(v), _zipped), F.when(F.schema_of_variant(v).startswith("ARRAY"), _listed(v))))


def _block(v: Column) -> Column:
    """The object of parallel arrays, alone or first in a list; else null."""
    first = F.when(F.try_variant_get(v, "$[0].price", "array<string>").isNotNull(), F.try_variant_get(v, "$[0]", "variant"))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v).otherwise(first)


def _zipped(block: Column) -> Column:
    path = lambda *names: F.coalesce(*[F.try_variant_get(block, f"$.{n}", "array<string>") for n in names])
    parts = F.struct(path("date", "dates").alias("dates"), path("type", "types").alias("types"), F.try_variant_get(block, "$.type", "string").alias("single"), path("price", "prices").alias("prices"), path("amount_transacted", "amount").alias("amounts"))

    def zipped(b: Column) -> Column:
        n = F.greatest(F.coalesce(F.size(b["prices"]), F.lit(0)), F.coalesce(F.size(b["amounts"]), F.lit(0)))
        types = F.coalesce(b["types"], F.when(b["single"].isNotNull(), F.array_repeat(b["single"], n)))
        return F.transform(zip_transactions(b["dates"], types, b["prices"], b["amounts"]), lambda t: F.struct(t["date"].alias("date"), t["type"].alias("type"), t["price"].try_cast("double").alias("price"), t["amount"].try_cast("double").try_cast("long").alias("amount")))

    return F.when(block.isNotNull(), once(parts, zipped))


def _listed(v: Column) -> Column:
    one = lambda o, *names: F.coalesce(*[F.try_variant_get(o, f"$.{k}", "string") for k in names])
    return F.transform(
        F.try_variant_get(v, "$", "array<variant>"),
        lambda o: F.struct(one(o, "transaction_date", "date").alias("date"), F.coalesce(one(o, "transaction_type", "type"), F.lit("other")).alias("type"), one(o, "transaction_price", "price").try_cast("double").alias("price"), one(o, "transaction_share_amount", "amount_transacted", "amount").try_cast("double").try_cast("long").alias("amount")),
    )


def collapse(txs: Column, date: Column, type_: Column) -> Column:
    """For storing: missing dates and types filled from the row."""
    return F.transform(txs, lambda t: F.struct(F.coalesce(t["date"], date).alias("date"), F.coalesce(t["type"], type_).alias("type"), t["price"].alias("price"), t["amount"].alias("amount_transacted")))


def structure_is_valid(txs: Column, type_: Column) -> Column:
    """Each transaction has date, type and a non-zero amount; none at all is fine unless the row buys or sells."""
    filled = lambda t: F.coalesce(t["date"].isNotNull() & (t["type"] != "") & (t["amount"] != 0), F.lit(False))
    return F.when(F.coalesce(F.size(txs), F.lit(0)) > 0, F.forall(txs, filled)).otherwise(~F.coalesce(type_.isin("buy", "sell"), F.lit(False)))


def drop_field(txs: Column, name: str = "purpose") -> Column:
    return F.transform(txs, lambda t: t.dropFields(name))


def name_of(x: Column) -> Column:
    """The `name` of a JSON-like string, or the string."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(x), "$.name", "string"), F.nullif(F.regexp_extract(x, r"['\"]name['\"]\s*:\s*['\"]([^'\"]+)['\"]", 1), F.lit("")), F.nullif(F.trim(x), F.lit("")))


def string_list(x: Column) -> Column:
    """Array of a JSON list or of comma-separated text, blanks left out; null if nothing is left."""
    arr = F.coalesce(F.try_variant_get(F.try_parse_json(x), "$", "array<string>"), F.split(x, ","))
    kept = F.filter(F.transform(arr, lambda t: F.trim(t)), lambda t: t.isNotNull() & (t != ""))
    return F.when(F.size(kept) > 0, kept)


def rows_of(raw: Column, keys: tuple[str, ...] = ("items", "rows", "alerts", "data", "results")) -> Column:
    """array<variant>: the list itself or the one under a container key."""
    v = F.try_parse_json(raw)
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), *[F.try_variant_get(v, f"$.{k}", "array<variant>") for k in keys])


def first_scalar(arr: Column) -> Column:
    return F.get(F.filter(arr, lambda t: t.isNotNull() & (t != "")), F.lit(0))


def last_number(x: Column) -> Column:
    """The last token of digits and marks in a text."""
    return F.try_element_at(F.regexp_extract_all(x, F.lit(r"(-?[0-9][0-9.,]*)"), F.lit(1)), F.lit(-1))


def first_int(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, r"([0-9]+)", 1), F.lit("")).try_cast("long")


def attachment_url(att: Column, keys=("url", "link", "href", "FullSavePath", "full_save_path", "path", "file_url", "download_url", "source")) -> Column:
    """The first http value among the aliases of an attachment in JSON, or the text itself."""
    v = F.try_parse_json(att)
    http = lambda c: F.when(c.rlike("(?i)^https?://"), c)
    return F.coalesce(*[http(F.try_variant_get(v, f"$.{k}", "string")) for k in keys], http(att))


def first_numbers(text: Column, least: int = 100, most: int = 5) -> Column:
    """The first whole numbers of a text that are not below `least`, thousands grouped or not."""
    found = F.regexp_extract_all(text, F.lit(r"([0-9]{1,3}(?:[.,][0-9]{3})+|[0-9]+)"), F.lit(1))
    values = F.transform(found, lambda x: F.translate(x, ".,", "").try_cast("long"))
    return F.slice(F.filter(values, lambda v: v >= least), 1, most)


def paired(prices: Column, amounts: Column) -> Column:
    """array<struct<price,amount>> as long as the shorter one, of prices above zero and amounts that aren't negative."""
    p, a = F.filter(prices, lambda x: x > 0), F.filter(amounts, lambda x: x >= 0)
    n = F.least(F.size(p), F.size(a))
    return F.slice(F.arrays_zip(p.alias("price"), a.alias("amount")), F.lit(1), F.greatest(n, F.lit(0)))


def prices_and_amounts(raw: Column, prices: Column, amounts: Column, price: Column, amount: Column) -> Column:
    """Pairs for an article: of the stored block, else of the row's arrays, else of its single values."""
    txs = parse_transactions(raw)
    block = paired(F.transform(txs, lambda t: t["price"]), F.transform(txs, lambda t: t["amount"]))
    some = lambda c: F.when(F.size(c) > 0, c)
    return F.coalesce(some(block), some(paired(prices, amounts)), paired(F.array(price.cast("double")), F.array(amount.cast("long"))))


def stable_json(items: Column) -> Column:
    """JSON of an array of structs in order, so that equal multisets have equal texts."""
    return F.to_json(F.array_sort(items))


def merged_symbols(*lists: Column) -> Column:
    """Trimmed upper-case symbols of all lists, each once, sorted."""
    every = F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])
    return F.array_sort(F.array_distinct(F.filter(F.transform(every, lambda t: F.upper(F.trim(t))), lambda t: t.isNotNull() & (t != ""))))
