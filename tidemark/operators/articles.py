"""Titles, bodies and article rows made from filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import with_z
from ..functions.text import dotted, is_url, symbol
from . import tags

# Title form and verb by transaction type.
TITLES = {
    "buy": ("{h} buys shares of {c}", "bought"),
    "sell": ("{h} sells shares of {c}", "sold"),
    "share-transfer": ("{h} transfers shares of {c}", "transferred"),
    "award": ("{h} was awarded shares of {c}", "was awarded"),
    "others": ("Change in {h}'s position in {c}", "executed a transaction for"),
    "inheritance": ("{h} inherits shares of {c}", "inherited"),
}
OTHER_TITLE = "{h} {t} transaction of {c}"


def _fill(form: str, **parts: Column) -> Column:
    """A template with columns in its braces."""
    import re

    return F.concat(*[parts[p[1:-1]] if p.startswith("{") else F.lit(p) for p in re.split(r"(\{\w+\})", form) if p])


def _count(x: Column) -> Column:
    return F.format_string("%,d", x.cast("long"))


def title_and_body(holder: Column, company: Column, type_: Column, amount: Column, before: Column, after: Column, purpose: Column) -> Column:
    """struct<title, body> of a filing."""
    kind = F.initcap(F.replace(type_, F.lit("-"), F.lit(" ")))
    title, verb = _fill(OTHER_TITLE, h=holder, t=kind, c=company), F.lit("executed a transaction for")
    for t, (form, v) in TITLES.items():
        title, verb = F.when(type_ == t, _fill(form, h=holder, c=company)).otherwise(title), F.when(type_ == t, v).otherwise(verb)
    shares = F.when(amount.isNotNull(), F.concat(_count(amount), F.lit(" shares"))).otherwise("shares")
    moved = lambda word: F.concat(F.lit(f" This {word} their holdings from "), _count(before), F.lit(" to "), _count(after), F.lit(" shares."))
    change = F.when(after > before, moved("increases")).when(after < before, moved("decreases")).when(after == before, F.concat(F.lit(" Their holdings remain at "), _count(after), F.lit(" shares."))).otherwise("")
    why = F.when(F.coalesce(purpose, F.lit("")) != "", F.concat(F.lit(" The stated purpose of the transaction was "), F.lower(purpose), F.lit("."))).otherwise("")
    return F.struct(title.alias("title"), F.concat(holder, F.lit(" "), verb, F.lit(" "), shares, F.lit(" of "), company, F.lit("."), change, why).alias("body"))


def rule_based(holder: Column, company: Column, sym: Column, type_: Column, price: Column, before: Column, after: Column) -> Column:
    """struct<title, body> of an article without a language model (C17)."""
    at = F.when(F.coalesce(price, F.lit(0.0)) != 0, F.concat(F.lit(" at approximately IDR "), dotted(F.rint(price)))).otherwise("")
    moved = lambda word: F.concat(F.lit(f", {word} holdings from "), dotted(before), F.lit(" to "), dotted(after))
    change = F.when(after > before, moved("increasing")).when(after < before, moved("decreasing")).when(after == before, F.concat(F.lit(", resulting in "), dotted(after), F.lit(" shares"))).otherwise("")
    body = F.concat(holder, F.lit(" "), type_, F.lit(" shares of "), company, F.lit(" ("), sym, F.lit(")"), at, change, F.lit(". This filing was disclosed by the exchange."))
    return F.struct(F.concat(holder, F.lit(" "), F.initcap(type_), F.lit(" Transaction of "), company).alias("title"), body.alias("body"))


def without_on_date(text: Column) -> Column:
    """A leading 'On <date>,' goes."""
    return F.regexp_replace(text, r"(?i)^\s*on\s+[^,]{3,40}(?:,\s*\d{4})?,\s*", "")


def bullets(**facts: Column) -> Column:
    """One '- name: value' line for each fact that isn't null."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"- {k}: "), v.cast("string")) for k, v in facts.items()])


def document_link(row: Column, index: Column, source: Column) -> Column:
    """The row's own link if it is one to a .pdf, else the one under its file name, else the source."""
    return F.coalesce(F.when(is_url(row) & F.lower(row).rlike(r"\.pdf([?#].*)?$"), row), F.nullif(index, F.lit("")), source)


def articles(filings: DataFrame, now: str | None = None) -> DataFrame:
    """Article rows of canonical filings (X17, X18): text by rule, tickers with suffix, sentiment by type; score and symbol are null.

    A row without a timestamp gets `now`; timestamps without an offset get a 'Z'.
    """
    before = F.col("holding_before")
    text = rule_based(F.coalesce("holder_name", "holder_type", F.lit("an insider")), F.coalesce("company_name", "symbol"), F.coalesce("symbol", F.lit("")), F.lower(F.coalesce("transaction_type", F.lit("transaction"))), F.col("price"), before, F.col("holding_after"))
    return filings.withColumn("__t", text).select(
        F.col("__t.title").alias("title"), without_on_date(F.col("__t.body")).alias("body"), "source", with_z(F.coalesce(F.nullif(F.trim(F.col("timestamp").cast("string")), F.lit("")), F.lit(now))).alias("timestamp"), "company_name",
        F.array_distinct(F.array_compact(F.array(symbol(F.col("symbol"))))).alias("tickers"), "sector", F.array_compact(F.array("sub_sector")).alias("sub_sector"),
        tags.record_tags(F.col("tags"), F.col("transaction_type")).alias("tags"), tags.sentiment(F.col("transaction_type")).alias("sentiment"),
        F.lit(None).cast("double").alias("score"), F.lit(None).cast("string").alias("symbol"),
    )
