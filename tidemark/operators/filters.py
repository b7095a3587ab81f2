"""Projections and predicates over announcements and filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import publish_time
from ..functions.text import basename, safe_filename, slug

# Columns that a filing must have.
REQUIRED = ["symbol", "timestamp", "holder_name", "transaction_type"]
# The columns that the filings table takes.
ALLOWED = [
    "symbol", "timestamp", "transaction_type", "holder_name", "holding_before", "holding_after", "amount_transaction",
    "share_percentage_before", "share_percentage_after", "share_percentage_transaction", "price", "transaction_value",
    "price_transaction", "title", "body", "source", "sector", "sub_sector", "tags", "holder_type", "source_is_manual",
]
# Skip reasons by which a row is not inserted.
SKIPPED = ["mixed_transaction_type", "transfer_only_transaction"]


def announcements(raw: DataFrame) -> DataFrame:
    """Normal form of raw announcements; those whose first attachment isn't a web address go (F1).

    Needs `Title, Code, PublishDate, Attachments array<struct<FullSavePath,OriginalFilename>>`.
    """
    att = F.col("Attachments")
    main = F.get(att, F.lit(0))["FullSavePath"]
    rest = F.filter(F.slice(att, 2, F.greatest(F.size(att) - 1, F.lit(0))), lambda a: a["FullSavePath"].rlike("(?i)^https?://"))
    extras = F.transform(rest, lambda a: F.struct(F.coalesce(a["OriginalFilename"], safe_filename(a["FullSavePath"])).alias("filename"), a["FullSavePath"].alias("url")))
    return raw.where((F.size(att) > 0) & main.rlike("(?i)^https?://")).select(
        F.col("PublishDate").alias("date"), F.col("Title").alias("title"), slug(F.col("Title")).alias("title_slug"), F.col("Code").alias("company_name"),
        main.alias("main_link"), main.alias("link"), safe_filename(main).alias("filename"), extras.alias("attachments"), F.size(extras).alias("attachment_count"),
        F.lit("Ownership Report").alias("category"), F.lit("Ownership Report").alias("description"),
    )


def in_window(ts: Column, lo: Column | None, hi: Column | None) -> Column:
    """Between both bounds, inclusive; true if either bound is missing (F2)."""
    if lo is None or hi is None:
        return F.lit(True)
    return F.when(lo.isNull() | hi.isNull(), True).otherwise(F.coalesce(ts.between(lo, hi), F.lit(False)))


def strictly_between(ts: Column, lo: Column, hi: Column, symbol: Column | None = None, symbols: list[str] | None = None) -> Column:
    """After lo and before hi, of some symbols if given."""
    some = (ts > lo) & (ts < hi)
    return some & symbol.isin(symbols) if symbols else some


def day_range(ts: Column, days: list[str]) -> Column:
    """From the first day to before the day after the last one, local days."""
    lo, hi = min(days), max(days)
    return (ts >= publish_time(F.lit(f"{lo}T00:00:00"))) & (ts < publish_time(F.lit(f"{hi}T00:00:00")) + F.expr("INTERVAL 1 DAY"))


def has_any_tag(tags: Column, keys: list[str]) -> Column:
    """Whether a key occurs in the tags' text, in any case."""
    text = F.lower(F.concat_ws(",", tags))
    return F.exists(F.array(*[F.lit(k.lower()) for k in keys]), lambda k: F.contains(text, k))


def is_valid_row(skip: Column, numbers: list[Column], txs: Column) -> Column:
    """Not skipped, not all zero, with transactions (F8)."""
    some = F.lit(False)
    for n in numbers:
        some = some | (F.coalesce(n.cast("double"), F.lit(0.0)) != 0)
    return ~F.coalesce(skip, F.lit(False)) & some & (F.coalesce(F.size(txs), F.lit(0)) > 0)


def missing_columns(cols: list[str] = REQUIRED) -> Column:
    """Names of required columns that are null, blank or zero."""
    empty = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).isin("", "0")
    return F.array_compact(F.array(*[F.when(empty(c), c) for c in cols]))


def allowed(rows: DataFrame, cols: list[str] = ALLOWED) -> DataFrame:
    """The columns that the sink takes (F10); nulls are left out by the JSON writer."""
    return rows.select(*[c for c in cols if c in rows.columns])


def not_skipped(rows: DataFrame) -> DataFrame:
    """Rows whose skip reason isn't a transfer or a mix."""
    return rows.where(~F.coalesce(F.col("skip_reason").isin(SKIPPED), F.lit(False)))


def legacy_rows(rows: DataFrame, year: int, ts: str = "timestamp", raw: str = "price_transaction") -> DataFrame:
    """Rows from a year on whose transactions are still one object."""
    return rows.where((F.year(ts) >= year) & F.schema_of_variant(F.try_parse_json(raw)).startswith("OBJECT"))


def holder_rows(tables: DataFrame, cells: str = "cells") -> DataFrame:
    """Table rows that hold a change: five cells at least, no header, total or public line, before and after differ."""
    first = F.lower(F.concat_ws(" ", F.slice(cells, 1, 2)))
    skip = first.rlike("(^|[^a-z])(no|nama|name|total|jumlah)([^a-z]|$)|masyarakat lainnya")
    return tables.where((F.size(cells) >= 5) & ~skip & ~F.get(cells, F.lit(2)).eqNullSafe(F.get(cells, F.lit(4))))


def announcement_block(title: Column, url: Column, pdf: Column) -> Column:
    """struct<title,url,pdf_url,filename,source_type>: idx if the address is the exchange's."""
    link = F.coalesce(F.nullif(pdf, F.lit("")), url)
    return F.struct(title.alias("title"), url.alias("url"), link.alias("pdf_url"), basename(link).alias("filename"), F.when(F.lower(link).contains("idx.co.id"), "idx").otherwise("non-idx").alias("source_type"))


def trimmed_announcement(a: str = "announcement") -> Column:
    keep = ["date", "title", "company_name", "main_link", "filename", "category", "attachment_count"]
    return F.struct(*[F.col(f"{a}.{k}").alias(k) for k in keep])


def in_source_order(*parts: DataFrame) -> DataFrame:
    """The chunks one after the other as `src_seq` says; columns that one lacks are null there."""
    out = parts[0].withColumn("src_seq", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        out = out.unionByName(part.withColumn("src_seq", F.lit(i)), allowMissingColumns=True)
    return out


def distinct_names(rows: DataFrame, name: str) -> DataFrame:
    """Trimmed names, each once, without blanks."""
    return rows.select(F.trim(name).alias(name)).where(F.col(name) != "").distinct()


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def sort_announcements(rows: DataFrame, descending: bool = False) -> DataFrame:
    """By publish time, title, link; unreadable times come first either way (O1)."""
    keys = [publish_time(F.col("date")), F.coalesce("title", F.lit("")), F.coalesce("link", F.lit(""))]
    return rows.orderBy(*[k.desc_nulls_first() if descending else k.asc_nulls_first() for k in keys])


def news_row(rows: DataFrame) -> DataFrame:
    """Fixed news columns; lists from JSON, commas or one value; score is null."""
    from ..functions.arrays import string_list
    from ..functions.dates import with_z

    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    arr = lambda c: have(c) if c in rows.columns and rows.schema[c].dataType.typeName() == "array" else string_list(have(c))
    return rows.select(have("title").alias("title"), have("body").alias("body"), have("source").alias("source"), with_z(have("timestamp")).alias("timestamp"), have("sector").alias("sector"), *[arr(c).alias(c) for c in ("sub_sector", "tags", "tickers")], F.lit(None).cast("string").alias("dimension"), F.lit(None).cast("string").alias("votes"), F.lit(None).cast("double").alias("score"))


def size_budget(rows: DataFrame, size: str, budget: int, tie: str, group: list[str] | None = None) -> DataFrame:
    """Smallest rows first as long as their running sum fits the budget (W8), within `group` if given.

    Without a group the sums run over ranges: rows are dealt by size and tie, the
    ranges' totals (as many as partitions) are summed up first, and each range goes on
    from what stands before it; no task sees more than its range. Sizes are not negative.
    """
    from pyspark.sql import Window

    if group:
        w = Window.partitionBy(*group).orderBy(size, tie).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("running", F.sum(size).over(w)).where(F.col("running") <= budget)
    # as the sum only grows, rows above the budget can't be kept and needn't be dealt
    dealt = rows.where(F.col(size) <= budget).repartitionByRange(F.col(size), F.col(tie)).withColumn("__part", F.spark_partition_id())
    dealt = dealt.persist()
    totals = dealt.groupBy("__part").agg(F.sum(size).alias("__sum"))
    before = F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("__part", F.coalesce(before, F.lit(0)).alias("__start")).where(F.col("__start") <= budget)
    w = Window.partitionBy("__part").orderBy(size, tie).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(F.broadcast(starts), "__part").withColumn("running", F.col("__start") + F.sum(size).over(w))  # one row a partition
    return out.where(F.col("running") <= budget).drop("__part", "__start")
