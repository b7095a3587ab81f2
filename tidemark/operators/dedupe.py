"""Duplicates inside a batch and against what is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`; null keys are equal."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*key, "__r.*")


def batch_dedupe(rows: DataFrame, key: list[str], edited: Column, created: Column, order: list[str]) -> DataFrame:
    """All rows with `skip_reason`: of equal keys the edited one stays, then the one whose created_at has the highest first character ('Z' if none), then the first."""
    mark = F.substring(F.coalesce(F.nullif(created, F.lit("")), F.lit("Z")), 1, 1)
    w = Window.partitionBy(*key).orderBy(edited.desc(), mark.desc(), *order)
    return rows.withColumn("skip_reason", F.when(F.row_number().over(w) > 1, "duplicate_in_batch"))


def canonical_float(x: Column, places: int = 6) -> Column:
    return F.coalesce(F.round(x.cast("decimal(38,10)"), places).cast("string"), F.lit(""))


def filing_hash(strings: list[Column], numbers: list[Column], day: Column) -> Column:
    """sha256 of one canonical line: texts trimmed and lower-cased, numbers with six decimals, nulls empty.

    A backslash goes before a bar or backslash inside a text, so that fields cannot run into each other.
    """
    text = [F.regexp_replace(F.lower(F.trim(F.coalesce(s.cast("string"), F.lit("")))), r"([|\\\\])", r"\\$1") for s in strings]
    return F.sha2(F.concat_ws("|", *text, *[canonical_float(n) for n in numbers], F.coalesce(F.substring(day.cast("string"), 1, 10), F.lit(""))), 256)


def new_rows(batch: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """Batch rows that aren't stored (J15, U3); the stored side is reduced to its distinct keys."""
    return batch.join(stored.select(*on).distinct(), on, "left_anti")


def statistics(batch: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """One row: input, unique, existing, to_insert."""
    keys = batch.groupBy(*on).agg(F.count("*").alias("__n"))
    hit = keys.join(stored.select(*on).distinct().withColumn("__hit", F.lit(1)), on, "left")
    return hit.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("input"), F.count("*").alias("unique_rows"), F.count("__hit").alias("existing"), (F.count("*") - F.count("__hit")).alias("to_insert"))
