"""The registered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import queries

KEYS = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op7_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_urls": ["page_id", "host", "path", "rule", "verdict"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_table(name, spark, sf):
    df = queries.QUERIES[name](spark, sf)
    assert set(KEYS.get(name, [])) <= set(df.columns)
    n = df.count()
    if name != "op4_decontaminate":
        assert n == spark.read.parquet(f"{sf}/{'pages' if name == 'op10_urls' else 'documents'}.parquet").count()


def test_held_out_languages(spark, sf):
    got = queries.op3_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(name, spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    tidy = lambda rows: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)
    res = con.execute(queries.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    assert tidy(df.select(*cols).collect()) == tidy([r[names.index(c)] for c in cols] for r in res.fetchall())


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.Table(stage(spark, docs, sf), name).df
        kept[name] = docs.count()
        assert name == "tokens" or docs.columns == columns
    assert before > kept["quality"] >= kept["line_dedup"] >= kept["near_duplicates"] >= kept["decontamination"] == kept["tokens"] > before / 2


def test_intermediate_tables_go_to_the_named_folder(spark):
    from tidemark.llm.scratch import Table, shared_dir

    t = Table(spark.range(3), "x")
    assert t.path.startswith(shared_dir(spark)) and t.small() and t.df.count() == 3
    t.drop()
    assert not os.path.exists(t.path.removeprefix("file:"))
