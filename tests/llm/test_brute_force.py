"""Operators without SQL against plain versions of themselves, and the pipeline's stages at their edges."""

import math
import random

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from test_findings import five_word_groups, near_rows

from tidemark.llm import decontaminate, jaccard_join, langid, lines, quality, queries, urls


def test_language_is_that_of_the_nearest_centroid_by_hand():
    rng = random.Random(2)
    vocab = {"a": ["alaba", "lambe", "balla"], "b": ["kröszt", "stürk", "øksz"], "c": ["olo", "tolo", "balo"]}
    texts = [(k, " ".join(rng.choice(v) for _ in range(rng.randrange(3, 30)))) for k, v in vocab.items() for _ in range(15)]
    model = langid.train(np.concatenate(list(langid.gram_counts([t for _, t in texts]))), [k for k, _ in texts])

    def grams(text):
        low = text.lower().encode()
        held = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in low)
        line = b" " + b" ".join(held.split()) + b" "
        out = {}
        for i in range(len(line) - 2):
            h = (((line[i] << 16 | line[i + 1] << 8 | line[i + 2]) * 0x9E3779B1) & 0xFFFFFFFF) >> 19
            out[h] = out.get(h, 0) + 1
        return out

    probes = [" ".join(rng.choice([*vocab["a"], *vocab["b"], *vocab["c"], "12", "Zeta!"]) for _ in range(rng.randrange(1, 12))) for _ in range(40)] + ["ALABA, balla; 3", "é"]
    lang, score, _ = model.predict(probes)
    for t, got, s in zip(probes, lang, score, strict=True):
        x = {h: math.log1p(n) * float(model.idf[h]) for h, n in grams(t).items()}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
        cos = [sum(v * float(c[h]) for h, v in x.items()) / norm for c in model.centroids]
        if any(c.isalpha() for c in t):
            assert got == model.langs[int(np.argmax(cos))] and s == pytest.approx(min(1, max(0, max(cos))), abs=1e-4)
        else:
            assert got == "und"


def loss_of(model, doc, feat, val, grade):
    """Regularised negative log likelihood of a cumulative-link model, row by row."""
    total = 0.0
    for i in range(len(grade)):
        z = sum(v * model.weights[f] for d, f, v in zip(doc, feat, val, strict=True) if d == i)
        below = [0.0, *[1 / (1 + math.exp(-(t - z))) for t in model.thresholds], 1.0]
        total -= math.log(max(1e-9, below[grade[i] + 1] - below[grade[i]]))
    return total / len(grade) + quality.DECAY / 2 * float((model.weights**2).sum())


def test_quality_fit_is_a_minimum_of_the_likelihood():
    rng = np.random.default_rng(5)
    n, features = 60, 12
    truth = rng.normal(size=features) * 3
    doc, feat, val, grade = [], [], [], []
    for i in range(n):
        own = rng.choice(features, 4, replace=False)
        v = rng.random(4)
        z = float(v @ truth[own]) + rng.logistic()
        doc += [i] * 4
        feat += own.tolist()
        val += v.tolist()
        grade.append(int(z > -1) + int(z > 1))
    doc, feat, val, grade = np.array(doc), np.array(feat), np.array(val), np.array(grade)
    model = quality.train(doc, feat, val, grade)
    assert model.thresholds[0] < model.thresholds[1]
    best = loss_of(model, doc, feat, val, grade)
    for j in range(features):  # a numeric gradient near nought, and no better place on either side
        for step in (-0.2, 0.2):
            other = quality.Model(model.weights.copy(), model.thresholds)
            other.weights[j] += step
            assert loss_of(other, doc, feat, val, grade) > best - 1e-4
    for step in (-0.2, 0.2):
        assert loss_of(quality.Model(model.weights, model.thresholds + step), doc, feat, val, grade) > best - 1e-4


def test_quality_scores_are_sums_of_weights():
    rng = np.random.default_rng(6)
    model = quality.Model(rng.normal(size=quality.DIM), np.array([-0.5, 0.25]))
    texts = ["Some words, Some WORDS here", "", None, "x", "other text: of words 12"]
    mean, top = model.score(texts)
    for i, t in enumerate(texts):
        latent = sum(float(v) * model.weights[f] for _, f, v, _n in quality.features([t]) for f, v in zip(f, v, strict=True)) if t else 0.0
        above = [1 / (1 + math.exp(-(latent - th))) for th in model.thresholds]
        assert mean[i] == pytest.approx(sum(above)) and top[i] == pytest.approx(above[-1])


def test_quality_keeps_held_out_good_documents_and_drops_toxic_ones(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    docs, labels = queries.table(spark, sf, "documents"), quality.grades(queries.table(spark, sf, "labels"))
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    got = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").select("grade", "kept").collect()
    good, bad = [r.kept for r in got if r.grade == 2], [r.kept for r in got if r.grade < 2]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.4 * len(bad)
    insults = r"(?i)\b(trash|pathetic|idiot|disgusting|worthless|stupid|clown|scum|loser|moron)\b"
    toxic = quality.judge(docs, quality.fit(docs, labels)).join(labels.where("grade = 0"), "doc_id").where(F.col("text").rlike(insults)).select("kept").collect()
    assert sum(r.kept for r in toxic) <= 0.1 * len(toxic)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def buckets(host, path):
    out = set()
    for tag, text in (("h", "^" + host), ("p", path + "$")):
        seed = xxhash.xxh64_intdigest(tag.encode(), seed=42)
        for n in urls.GRAMS:
            out |= {signed(xxhash.xxh64_intdigest(text[i : i + n].encode(), seed=seed)) % urls.DIM for i in range(len(text) - n + 1)}
    return out


def test_url_scores_by_hand_and_unseen_urls(spark):
    unseen = [
        ("https://www.history.example.org/en/articles/412", 0), ("https://docs.library.example.net/python/guide.html", 0), ("http://university.example.com/papers/2021/77", 0), ("https://news.city.example.org/world/article-12", 0),
        ("https://www.museum.example.net/de/2291.html", 0), ("https://weather.example.com/forum/t/9", 0), ("http://cheap-viagra.example.org/buy/pills", 1), ("https://casino-slots.example.net/bonus/free-spins", 1),
        ("http://adult-cams.example.com/live/xxx", 1), ("https://warez-crack.example.org/download/keygen", 1), ("http://free-prize.example.net/win/money", 1), ("https://poker-betting.example.org/jackpot", 1), (None, 0), ("no scheme", 0),
    ]
    rows = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(unseen)], "page_id bigint, url string")
    weights, intercept = urls.fit(urls.labelled_urls(spark))
    got = {r.page_id: r for r in urls.judge(rows, rules=[]).collect()}
    for r in got.values():
        ids = buckets(r.host, r.path)
        z = intercept + (sum(weights[i] for i in ids) / math.sqrt(len(ids)) if ids else 0.0)
        assert r.p_block == pytest.approx(1 / (1 + math.exp(-z))) and r.verdict == ("block" if r.p_block >= 0.5 else "allow")
    assert sum((got[i].verdict == "block") == bool(y) for i, (u, y) in enumerate(unseen[:12])) >= 11


def test_url_parts_and_rules_equal_sql(spark, sf):
    sql = r"""WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
      r(h, q) AS (VALUES ('com', '/'), ('example.com', '/en/'), ('www.example.com', '/en/'), ('net', '/es/'), ('net', '/fr/'))
      SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(h || q, length(h || q)) AS rule FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id"""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = sorted(con.execute(sql).fetchall())
    got = sorted(tuple(r) for r in queries.op10_urls(spark, sf).select("page_id", "host", "path", "rule").collect())
    assert got == want


def test_fingerprint_texts_equal_sql(spark, sf):
    sql = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS n FROM documents)
      SELECT doc_id, length(t) AS n_chars, sha256(substr(t, 1, length(t) - length(t) // 2) || substr(n, 1, length(t) // 2)) AS edited_sha256 FROM d"""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(sql).fetchall())
    got = sorted(tuple(r) for r in queries.op7_fingerprints(spark, sf).select("doc_id", "n_chars", "edited_sha256").collect())
    assert got == want


@pytest.mark.parametrize("percent", [50, 70, 95])
def test_jaccard_join_at_other_thresholds(spark, percent):
    rows = near_rows()
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b c d", "a b c d e", "a b c d e f", "p q r s t u", "p q r s t x"])]
    got = jaccard_join.link(spark.createDataFrame(rows, "doc_id bigint, text string"), words=5, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == five_word_groups(rows, percent)


def test_parity_bits_never_hide_a_link(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = []
    for i in range(25):
        w = list(base)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = jaccard_join.link(spark.createDataFrame(rows, "doc_id bigint, text string"), words=5, percent=80, frequent=2).collect()
    assert {r.doc_id: r.component_id for r in got} == five_word_groups(rows)


ITEM = "what is the name of the river that runs past the old town"


@pytest.fixture(scope="module")
def sf_small(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(1, ITEM), (2, "short item here"), (3, None), (4, "")], "item_id bigint, text string").write.parquet(str(at / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").where("false").write.parquet(str(at / "labels.parquet"))
    return str(at)


def test_decontamination_judges_each_row_by_its_text(spark, sf_small):
    rows = [(None, f"before {ITEM} behind", "a"), (None, "clean words of a text without id", "b"), (5, f"{ITEM}", "c"), (5, "clean words of the same id", "d"), (6, None, "e"), (7, "", "f"), (8, "a Short, item here!", "g"), (9, "short item", "h"), (5, f"{ITEM}", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    out = corpus_pipeline.decontamination_stage(spark, docs, sf_small)
    assert out.columns == docs.columns and sorted(r.item_id for r in out.collect()) == ["b", "d", "e", "f", "h"]


def test_near_duplicates_keep_one_of_equal_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    rows = [(5, t, 1), (5, t, 1), (6, t, 2), (7, "words of its own that are long enough to count", 3), (7, "second text of that id, unlike the first one in all", 4), (None, t, 5), (None, t, 5), (8, None, 6), (9, "", 7)]
    out = corpus_pipeline.near_duplicates_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string, count int"), "")
    assert sorted((r.doc_id or 0, r["count"]) for r in out.collect()) == [(0, 5), (0, 5), (5, 1), (7, 4), (8, 6), (9, 7)]


def test_stages_at_their_edges(spark, docs, empty, sf_small):
    """Nulls, empty and long texts, repeated rows, no rows, further columns with names that operators use."""
    for rows in (docs, docs.unionByName(docs), empty):
        before = rows.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf_small)
            assert name == "tokens" or out.columns == rows.columns
            assert out.count() <= before if name != "tokens" else out.count() == before


def test_stages_equal_plain_versions(spark, docs, pairs, sf_small):
    """What each stage keeps of the same documents, by brute force where a model does not decide."""
    from test_llm_operators import brute_contained, brute_lines

    known = [(i, t) for i, t in pairs if i is not None]
    kept = {r.doc_id for r in corpus_pipeline.decontamination_stage(spark, docs, sf_small).collect()}
    hit = {d for d, _ in brute_contained(pairs, [(1, ITEM), (2, "short item here")])}
    assert kept == {i for i, _ in pairs} - hit
    groups = five_word_groups(known)
    near = {r.doc_id for r in corpus_pipeline.near_duplicates_stage(spark, docs, sf_small).collect()}
    assert near == {i for i, c in groups.items() if i == c} | {None}
    cut = {r.doc_id: r.text for r in corpus_pipeline.lines_stage(spark, docs, sf_small).collect()}
    want = brute_lines(pairs)
    assert {i: t or "" for i, t in cut.items()} == {i: w for i, w in want.items() if w.strip() or w == dict(pairs)[i]}
    model = quality.fit(docs, quality.grades(queries.table(spark, sf_small, "labels")))
    _, top = model.score([t for _, t in pairs])
    judged = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, sf_small).collect()}
    assert judged == {i for (i, _), p in zip(pairs, top, strict=True) if p >= quality.CUT}
