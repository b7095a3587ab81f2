"""Each operator against a brute-force version on texts that hold the awkward cases."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bpe, components, decontaminate, fingerprints, jaccard_join, langid, licences, lines, quality, repeats, urls

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def shingles(text, k):
    w = [x.lower() for x in WORD.findall(text.encode())]
    return {b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} or ({b" ".join(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_equals_the_library(docs, pairs, vocabulary):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary)
    got = {(r.doc_id): r for r in bpe.encode(docs, vocabulary).collect()}
    for i, t in pairs:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(",".join(map(str, ids)))
        assert got[i].decoded_sha256 == sha(lib.decode(ids, skip_special_tokens=False))
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()}
    assert back == dict(pairs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aab \n'st.12é²\x1c\xa0_"), st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"])), max_size=40), max_size=5))
def test_bpe_on_any_text(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path) as f:
        c = bpe.codec(f.read())
    lib = _lib.setdefault(path, None) or _lib.update({path: Tokenizer.from_file(path)}) or _lib[path]
    for t, ids in zip(texts, c.encode_batch(texts), strict=True):
        assert ids == lib.encode(t, add_special_tokens=False).ids
        assert c.decode(ids) == t


_lib = {}


def brute_repeats(pairs, length=200):
    seen = Counter(b[j : j + length] for _, t in pairs if (b := t.encode()) for j in range(len(b) - length + 1))
    out = {}
    for i, t in pairs:
        b = t.encode()
        gone = np.zeros(len(b) + 1, int)
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j] += 1
                gone[j + length] -= 1
        f = np.cumsum(gone)[:-1] > 0
        out[i] = (len(b), int(f.sum()), int((np.diff(np.concatenate(([0], f.astype(int)))) == 1).sum()), sha(np.frombuffer(b, np.uint8)[~f].tobytes()))
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeats_equal_brute_force(docs, pairs, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect()}
    assert got == brute_repeats(pairs)
    assert sum(v[1] for v in got.values()) > 0


def test_repeats_of_equal_rows(spark):
    t = "".join(chr(97 + i * i % 23) for i in range(250))
    df = spark.createDataFrame([(1, t), (1, t), (None, t[:199])], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in repeats.remove_repeats(df).collect()) == [(0, 0), (1, 250), (1, 250)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=200, max_size=215), st.integers(1, 2)), min_size=1, max_size=6, unique_by=lambda x: x[0]))
def test_run_index_marks(segments):
    base = segments[0][0]
    rows = dict(segments) | {base[3:200] + b"abc" + base[:9]: 1}
    found = repeats.marks(list(rows), list(rows.values()))
    seen = Counter()
    for s, c in rows.items():
        for j in range(len(s) - 199):
            seen[s[j : j + 200]] += c
    assert all((f == np.array([seen[s[j : j + 200]] > 1 for j in range(len(s) - 199)])).all() for s, f in zip(rows, found, strict=True))


def test_langid(spark):
    import random

    rng = random.Random(1)
    vocab = {"aa": ["alaba", "lamba", "balla", "malab"], "bb": ["kröszt", "stürk", "ökszt", "trüs"]}
    rows = [(i, " ".join(rng.choice(vocab[k]) for _ in range(30)), k, "s") for i in range(120) for k in [["aa", "bb"][i % 2]]]
    rows += [(1000, None, "aa", "s"), (1001, "12 34 !", "bb", "s"), (1002, "x" * 5000, None, "s"), (None, "alaba", "aa", "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    model = langid.fit(df, per_lang=20)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert all(got[i].lang_pred == k for i, _, k, _ in rows[:120])
    assert (got[1000].lang_pred, got[1000].score) == ("und", 0.0) and got[1001].lang_pred == "und"
    assert got[1002].lang_pred in ("aa", "bb") and got[1002].rejected
    assert all(0 <= r.score <= 1 for r in got.values()) and got[None].held_out is False
    import zlib

    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows[:120])


def test_langid_without_rows(docs, empty):
    model = langid.fit(empty)
    assert {r.lang_pred for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def brute_contained(pairs, items, t=0.8):
    words = lambda x: [w for w in re.split(r"[\W_]+", x.lower()) if w]
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    out = {}
    for k, y in items:
        if y and k is not None and (own := words(y)):
            size = min(5, len(own))
            s = grams(own, size)
            out |= {(d, k): round(len(s & grams(words(x), size)) / len(s), 9) for d, x in pairs if d is not None and len(s & grams(words(x), size)) >= t * len(s)}
    return out


def test_decontamination(spark, docs, pairs, texts):
    w = texts[5].split()
    part = lambda a, b: " ".join(w[a:b])
    changed = w[10:60]
    changed[3] = changed[40] = "new"
    items = [(1, part(3, 30).upper()), (2, ", ".join(w[20:40])), (3, part(0, 4)), (4, None), (5, " ".join(changed)), (6, "zz " * 30), (7, ""), (None, part(0, 30)), (8, part(40, 45))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): round(r.containment, 9) for r in decontaminate.find(docs, bench).collect()}
    want = brute_contained(pairs, [(k, y or "") for k, y in items if k is not None])
    assert got == want and {k for _, k in got} >= {1, 2, 5, 8}
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).count() == 0


def test_quality(spark, docs, empty):
    import random

    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["river", "stone", "cloud", "tree", "house", "field"]) for _ in range(40)) + "."
    poor = lambda: " ".join(w.upper() + "!!" for w in good().split())
    toxic = lambda: good() + " vile awful " + good() + " vile"
    rows = [(i, (toxic, poor, good)[i % 3](), i % 3) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept int")
    labels = spark.createDataFrame([(i, int(g != 1), int(g == 0)) for i, _, g in rows if i < 150] + [(None, 1, 0), (3, None, None)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(df, quality.grades(labels))
    assert (np.diff(model.thresholds) > 0).all()
    got = quality.judge(df, model).collect()
    held = [r for r in got if r.doc_id >= 150]
    assert np.mean([r.kept == (r.doc_id % 3 == 2) for r in held]) > 0.95
    mean = [np.mean([r.expected_grade for r in held if r.doc_id % 3 == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert quality.judge(docs, model).count() == docs.count() and quality.judge(empty, model).count() == 0
    assert quality.fit(docs, quality.grades(labels.limit(0))).weights.any() == False  # noqa: E712


def brute_components(pairs, percent=85):
    sets = {i: shingles(t, 4) for i, t in pairs if i is not None}
    home = {i: i for i in sets}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in sets:
        for b in sets:
            i = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                x, y = sorted((find(a), find(b)))
                home[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("frequent", [64, 1])
def test_jaccard_join_equals_brute_force(docs, pairs, frequent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(docs, frequent=frequent).collect()}
    assert got.pop(None)[1] is None
    want = brute_components(pairs)
    assert got == want and sum(i != c for i, (_, c) in want.items()) >= 5


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10**6))
def test_jaccard_join_on_families(seed):
    import random

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rng = random.Random(seed)
    rows = []
    for f in range(3):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 90))]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(6)}"
            rows.append((len(rows), " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(spark.createDataFrame(rows, "doc_id bigint, text string"), frequent=rng.choice([2, 8])).collect()}
    assert got == brute_components(rows)


def test_jaccard_join_of_repeated_ids_and_no_rows(spark, empty):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(5, t), (9, t), (9, "other words that nobody has at all here"), (7, "other words that nobody has at all here")], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.link(df).collect()} == {(5, 5), (9, 5), (7, 5)}
    assert jaccard_join.link(empty).count() == 0


def test_components_of_a_path_take_few_rounds(spark, monkeypatch):
    steps = []

    class Counted(components.Table):
        def __init__(self, df, name):
            steps.append(name)
            super().__init__(df, name)

    monkeypatch.setattr(components, "Table", Counted)
    links = [(i, i + 1) for i in range(-500, 500)] + [(5000 + 2 * i, 5000 + 2 * i + 2) for i in range(20)] + [(2**62, -(2**62)), (9000, 9000), (None, 3)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    want = {i: -500 for i in range(-500, 501)} | {5000 + 2 * i: 5000 for i in range(21)} | {2**62: -(2**62), -(2**62): -(2**62)}
    assert got == want and steps.count("step") <= 20


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (12, 11), (4, 4), (9, 8), (8, 7), (7, 6), (6, 5), *[(100 + i, 101 + i) for i in range(40)]]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, **dict.fromkeys(range(5, 10), 5), **dict.fromkeys(range(100, 141), 100)}


def test_fingerprints(docs, pairs, empty):
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0), reverse=True)
    got = {r.doc_id: r for r in fingerprints.compare_neighbours(docs).collect()}
    assert len(got) == len(pairs)
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        new = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(new))
        assert abs(r.near_edited - jaccard(shingles(t, 5), shingles(new, 5))) < 0.2
        assert abs(r.near_next - jaccard(shingles(t, 5), shingles(after, 5))) < 0.2
    by_text = {}
    for i, t in pairs:
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint
    assert fingerprints.compare_neighbours(empty).count() == 0
    assert fingerprints.compare_neighbours(docs.where("doc_id = 0")).first().near_next == 1.0


def test_sketches_merge(docs, spark):
    rng = np.random.default_rng(1)
    a, b = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64)), np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    a *= np.uint64(2)
    both = np.unique(np.concatenate((a[:1500], b * np.uint64(2))))
    a, both = np.sort(a), np.sort(both)
    k = fingerprints.K
    assert (fingerprints.merge(a[:k], both[:k]) == np.union1d(a, both)[:k]).all()
    assert abs(fingerprints.distinct(a[:k]) / len(a) - 1) < 0.3
    assert (fingerprints.from_text(fingerprints.to_text(a[:k])) == a[:k]).all()
    whole = fingerprints.merge_groups(docs.withColumn("all", F.lit(1)), "all").first().hashes
    every = np.unique(np.concatenate([s for s in fingerprints.sketch([r.text for r in docs.collect()])]))[:k]
    assert (np.array(whole).view(np.uint64) ^ np.uint64(1 << 63) == every).all()


def test_licences(spark, docs, empty):
    mit = licences.TEMPLATES["MIT"]
    rows = [
        (1, "words before\n" + mit.replace("Software", "software") + "\nand behind"), (2, "Licensed under the Apache License, Version 2.0."), (3, "unlicensed words of any kind"),
        (4, "x y z\nThis work is licensed under the GNU General Public License, version 3.\nx"), (5, None), (6, ""), (7, "All rights reserved."), (8, " ".join(mit.split()[:60])),
    ]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i].licence for i in range(1, 9)] == ["MIT", "Apache-2.0-line", None, "GPL-3.0-line", None, None, "All-rights-reserved", None]
    assert got[2].dice == 1.0 and got[1].dice > 0.95 and got[1].licences[0].first_word == 2
    assert licences.scan(empty).count() == 0 and licences.scan(docs).count() == docs.count()


def brute_edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(diag + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def brute_lines(pairs, least=20, edits=2):
    first = {}
    for i, t in sorted(((i, t) for i, t in pairs), key=lambda p: (p[0] is not None, p[0] or 0)):
        for p, x in enumerate(t.split("\n")):
            if len(x) >= least or x.strip():
                first.setdefault(x, (i is not None, i or 0, p))
    gone = {x for x in first for y in first if min(len(x), len(y)) >= least and first[y] < first[x] and abs(len(x) - len(y)) <= edits and brute_edit(x, y) <= edits}
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if x not in first or x not in gone and first[x] == (i is not None, i or 0, p)) for i, t in pairs}


def test_lines_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    pool = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 34))) for _ in range(14)]

    def changed(x):
        x = list(x)
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(len(x))
            rng.choice([lambda: x.insert(k, "z"), lambda: x.pop(k), lambda: x.__setitem__(k, "y")])()
        return "".join(x)

    rows = [(i, "\n".join([changed(rng.choice(pool)) for _ in range(4)] + ["short", ""])) for i in range(40)]
    rows += [(100, ""), (None, pool[0]), (101, "a" * 5000), (102, "a" * 5002)]
    got = {r.doc_id: r for r in lines.dedup(spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, n_lines int")).collect()}
    want = brute_lines(rows)
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_lines == len(dict(rows)[i].split("\n")) and r.n_removed == r.n_lines - (len(want[i].split("\n")) if want[i] or dict(rows)[i] in ("",) or r.n_lines > r.n_removed else 0) for i, r in got.items())
    assert sum(r.n_removed for r in got.values()) > 40


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_lines_equal_brute_force(spark, seed):
    """Lines that share most of their text with an earliest line that few of them are near to."""
    import random

    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 3, 6])))
    bases = [[word() for _ in range(12)] for _ in range(3)]
    rows = []
    for i in range(60):
        held = []
        for _ in range(3):
            w = list(rng.choice(bases))
            w[rng.randrange(len(w))] = word()
            held.append(" ".join(w).ljust(24, "."))
        rows.append((i, "\n".join(held)))
    got = lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == brute_lines(rows)


def test_rows_of_one_id_are_told_apart_by_their_texts(spark):
    a, b = "the first of two texts with one id", "the other text, which has another line"
    rows = [(7, a), (7, a), (7, f"{b}\n{a}"), (8, b), (8, None), (None, "a line of a text that has no id")]
    got = sorted((r.doc_id or 0, r.text or "", r.n_removed) for r in lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    whole = [(0, rows[-1][1], 0), (8, "", 0), (8, "", 1)]
    assert got in (sorted([*whole, (7, a, 0), (7, a, 0), (7, b, 1)]), sorted([*whole, (7, "", 1), (7, "", 1), (7, f"{b}\n{a}", 0)]))


def test_lines_edge_cases(docs, empty):
    out = lines.dedup(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"] and out.count() == docs.count()
    nulls = out.where("text is null").collect()
    assert [(r.n_lines, r.n_removed) for r in nulls] == [(0, 0)]
    assert lines.dedup(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_banded_distance(a, b):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    chars = lambda s: F.array(*[F.lit(c) for c in s]) if s else F.array().cast("array<string>")
    got = spark.range(1).select(lines.within(chars(a), chars(b), 2)).first()[0]
    assert got is (brute_edit(a, b) <= 2)


CASES = [
    ("http://www.Example.COM/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("https://example.com/english", "example.com", "/english", "com/", "allow"),
    ("http://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("http://net/fr/", "net", "/fr/", "net/fr/", "block"),
    ("http://x.com", "x.com", "", None, None),
    ("http://x.com?a=/en/", "x.com", "", None, None),
    ("no scheme.com/en/", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("a://b://c.com/x", "b:", "//c.com/x", None, None),
    ("http://ÄB.com/É", "Äb.com", "/É", "com/", "allow"),
]


def test_urls(spark):
    df = spark.createDataFrame([(i, c[0], "<p>", "x") for i, c in enumerate(CASES)], "page_id bigint, url string, html string, host string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), CASES[i]
        assert got[i].verdict == verdict if verdict else got[i].verdict == ("block" if got[i].p_block >= urls.CUT else "allow")
    weights, intercept = urls.fit(urls.labelled_urls(spark))
    table = urls.labelled_urls(spark)
    p = urls.probability(urls.host_of(F.col("url")), urls.path_of(F.col("url")), weights, intercept)
    assert table.select(F.avg(((p >= 0.5).cast("int") == F.col("label")).cast("double"))).first()[0] > 0.95
    assert "Python" not in urls.judge(df)._jdf.queryExecution().executedPlan().toString()
