"""A training-data pipeline over `documents`, five stages that each call one operator.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last
return the columns of `documents`. `run` applies them in order and writes each
result as Parquet in the shared folder before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard_join, lines, quality
from tidemark.llm.queries import table
from tidemark.llm.scratch import Table


def _tagged(docs: DataFrame) -> DataFrame:
    """Documents with `__tag`, a hash of their text: with the id it names a row and its copies, a null id too."""
    return docs.withColumn("__tag", F.xxhash64("text"))


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose doc_id isn't in `dropped`, or whose doc_id and text aren't if it has `__tag`; null ids are equal there."""
    tagged = "__tag" in dropped.columns
    rows = _tagged(docs) if tagged else docs
    ids = Table(dropped.select(F.col("doc_id").alias("__id"), *([F.col("__tag").alias("__of")] if tagged else [])).distinct(), "dropped")
    same = rows["doc_id"].eqNullSafe(F.col("__id"))
    return rows.join(F.broadcast(ids.df) if ids.small() else ids.df, same & (F.col("__tag") == F.col("__of")) if tagged else same, "left_anti").select(*docs.columns)


def _one_an_id(docs: DataFrame) -> DataFrame:
    """Of rows with one id that isn't null the first in order of text, then of the other columns; the rest as it is."""
    often = Table(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "often")
    if often.df.isEmpty():
        return docs
    few = F.broadcast(often.df) if often.small() else often.df
    row = F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    first = docs.join(few, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("r")).select("doc_id", "r.*").select(*docs.columns)
    return docs.join(few, "doc_id", "left_anti").select(*docs.columns).unionByName(first)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose top grade is at least as likely as not; a null text is judged as an empty one, and without labels all get one verdict."""
    model = quality.fit(docs, quality.grades(table(spark, sf_dir, "labels")))
    return quality.judge(docs, model).where("kept").select(*docs.columns)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without non-blank lines that stand earlier, short ones included; documents of which nothing but white space is left by that go."""
    out = lines.dedup(docs)
    some = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"^\s*$")
    return out.where(some | (F.col("n_removed") == 0)).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates: five-word Jaccard of 0.8 or more.

    Rows with one id are one document, and one of them stays. Null ids take no
    part, and texts without words are near to nothing.
    """
    return _one_an_id(_without(docs, jaccard_join.link(docs, words=5, percent=80).where("component_id <> doc_id")))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item: each row by its own text, whatever its id."""
    rows = _tagged(docs).select(F.struct("doc_id", "__tag").alias("doc_id"), "text")
    return _without(docs, decontaminate.find(rows, table(spark, sf_dir, "benchmark")).select("doc_id.*"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, ids, n_tokens, ids_sha256, decoded_sha256` of every document; a null text has no ids."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("tokens", tokens_stage),
]

#: A trained classifier and a tokenizer are not SQL; tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Table(stage(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)
