"""Lookup joins: documents by any of their names, companies by symbol or name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename, company_key, kebab, pretty_company, stem, symbol_base

#: A dimension is broadcast up to so many rows and bytes; beyond it Spark chooses.
SMALL_ROWS = 200_000
SMALL_BYTES = 16 << 20


def small(dim: DataFrame) -> DataFrame:
    """The dimension with a broadcast hint if a bounded count of its rows and of their bytes as JSON shows that it is small."""
    rows, size = dim.limit(SMALL_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in dim.columns])))), F.lit(0))).first()
    return F.broadcast(dim) if rows <= SMALL_ROWS and size <= SMALL_BYTES else dim


def last_wins(rows: DataFrame, key: list[str], seq: list[str]) -> DataFrame:
    """One row a key, the last by `seq` (W5): a max with map-side combine, no window."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("__r")).select(*key, "__r.*")


def aliases(name: Column) -> Column:
    """array<struct<pri,alias>>: exact, base name, stem; those that repeat an earlier one are left out."""
    arr = F.array(name, basename(name), stem(name))
    return F.filter(F.transform(arr, lambda a, i: F.struct(i.alias("pri"), F.when(a.isNotNull() & (F.array_position(F.transform(arr, lambda x: F.coalesce(x, F.lit(""))), a) == i + 1), a).alias("alias"))), lambda s: s["alias"].isNotNull())


def alias_index(docs: DataFrame, name: str, seq: str) -> DataFrame:
    """`alias` and the last document that has it."""
    each = docs.select("*", F.explode(F.transform(aliases(F.col(name)), lambda s: s["alias"])).alias("alias"))
    return last_wins(each, ["alias"], [seq])


def alias_join(left: DataFrame, id_: str, names: list[str], index: DataFrame, carry: list[str]) -> DataFrame:
    """Left rows with `carry` of the document that the first of their names hits, exact before base name before stem."""
    cands = F.flatten(F.array(*[F.transform(aliases(F.col(n)), lambda s, k=k: F.struct((s["pri"] + 3 * k).alias("pri"), s["alias"].alias("alias"))) for k, n in enumerate(names)])) if len(names) > 1 else aliases(F.col(names[0]))
    probes = left.select(id_, F.explode(cands).alias("p")).select(id_, "p.pri", "p.alias")
    hits = probes.join(index.select("alias", *carry), "alias")
    best = hits.groupBy(id_).agg(F.min_by(F.struct(*carry), "pri").alias("__hit"))
    return left.join(best, id_, "left").select(*left.columns, *[F.col(f"__hit.{c}").alias(c) for c in carry])


def _one_a_base(companies: DataFrame) -> DataFrame:
    """Company columns by `__k`, the symbol without suffix; of several rows the one with the last symbol, then the last values."""
    rest = [c for c in companies.columns if c != "symbol"]
    return last_wins(companies.withColumn("__k", symbol_base(F.col("symbol"))), ["__k"], ["symbol", *rest]).drop("symbol")


def company_join(rows: DataFrame, companies: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Company columns by symbol with or without suffix (J6, X4, X5), prices under any of their names."""
    dim = _one_a_base(companies)
    return rows.withColumn("__k", symbol_base(F.col(symbol))).join(small(dim), "__k", "left").drop("__k")


def enriched_sector(own: Column, dim: Column) -> Column:
    """Slug of the row's sector, else of the company's, else unknown."""
    return F.coalesce(kebab(own), kebab(dim), F.lit("unknown"))


def exact_name(rows: DataFrame, name: str, companies: DataFrame) -> DataFrame:
    """`symbol` of the company whose normalised name is the row's, the first by symbol order."""
    dim = companies.select(company_key(F.col("company_name")).alias("__key"), "symbol").where("__key <> ''").groupBy("__key").agg(F.min("symbol").alias("symbol"))
    return rows.withColumn("__key", company_key(F.col(name))).join(small(dim), "__key", "left").drop("__key")


def ticker_in_text(text: Column) -> Column:
    """Tokens of three or four capitals in order of the text."""
    return F.regexp_extract_all(text, F.lit(r"\b([A-Z]{3,4})\b"), F.lit(1))


def named_company(text: Column) -> Column:
    """The first 'PT … Tbk' of a text."""
    return F.nullif(F.trim(F.regexp_extract(text, r"(PT\.?\s+[A-Z][\w .&,-]{1,80}?\s+Tbk)", 1)), F.lit(""))


def resolve(rows: DataFrame, id_: str, text: str, name: str, companies: DataFrame, code: str | None = None, least: float = 85.0) -> DataFrame:
    """`symbol, display_name` of each row.

    In this order: the document's own `code` if it is a known symbol, the stated
    name exactly, the nearest name at or above `least`, the first 'PT … Tbk' of the
    text exactly or nearest, the first three or four capitals of the text that are a
    known symbol. The base of a symbol is compared; of two spellings the first by
    order stands for it.
    """
    from .fuzzy import best_match

    known = companies.select(symbol_base(F.col("symbol")).alias("token"), "symbol").groupBy("token").agg(F.min("symbol").alias("__s"))
    own = symbol_base(F.col(code)) if code else F.lit(None).cast("string")
    src = rows.select(F.col(id_).alias("__id"), F.col(name).alias("__said"), named_company(F.col(text)).alias("__found"), own.alias("token"), F.col(text).alias("__text"))
    by_code = src.join(small(known), "token").select("__id", F.col("__s").alias("symbol"), F.lit(0).alias("__o"))
    steps = [by_code]
    for k, said in enumerate(("__said", "__found")):
        asked = src.where(F.col(said).isNotNull()).select("__id", F.col(said).alias("said"))
        steps.append(exact_name(asked, "said", companies).where("symbol is not null").select("__id", "symbol", F.lit(1 + 2 * k).alias("__o")))
        steps.append(best_match(asked, "__id", "said", companies, "symbol", "company_name", least).select("__id", "symbol", F.lit(2 + 2 * k).alias("__o")))
    tokens = src.select("__id", F.posexplode(ticker_in_text(F.col("__text"))).alias("pos", "token")).join(small(known), "token")
    steps.append(tokens.groupBy("__id").agg(F.min_by("__s", "pos").alias("symbol")).select("__id", "symbol", F.lit(5).alias("__o")))
    every = steps[0]
    for step in steps[1:]:
        every = every.unionByName(step)
    best = every.groupBy("__id").agg(F.min_by("symbol", F.struct("__o", "symbol")).alias("symbol"))
    out = rows.drop("symbol", "display_name").join(best.withColumnRenamed("__id", id_), id_, "left")
    names = companies.groupBy("symbol").agg(F.min("company_name").alias("__n"))
    return out.join(small(names), "symbol", "left").withColumn("display_name", F.coalesce("__n", pretty_company(F.col(name)))).drop("__n")


def latest_row(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by `order`, ties by the other columns."""
    return last_wins(rows, [key], [order, *[c for c in rows.columns if c not in (key, order)]]).select(*rows.columns)
