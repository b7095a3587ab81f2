"""Places where an operator or a stage did less than its whole job."""

import random

import corpus_pipeline
import numpy as np
import pytest

from tidemark.llm import jaccard_join, licences, lines, repeats, shingles


def five_word_groups(rows, percent=80):
    """Smallest id of each document's group, by brute force."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    home = {i: i for i in sets}

    def find(x):
        return x if home[x] == x else find(home[x])

    for a in sets:
        for b in sets:
            i = len(sets[a] & sets[b])
            if a < b and i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                x, y = sorted((find(a), find(b)))
                home[y] = x
    return {i: find(i) for i in sets}


def near_rows():
    """Families with J about the threshold, and texts of 4 to 7 shingles with a word put behind them."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    rows = []
    for size in (40, 60, 90):
        base = [word() for _ in range(size)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
    for size in (4, 5, 7, 8, 9, 10, 11):
        w = [word() for _ in range(size)]
        rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join([*w, word()]))]
    return rows


def test_near_duplicates_stage_links_five_words_at_80_percent(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = five_word_groups(rows)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()}
    assert got == {i for i, c in want.items() if i == c}
    small = {len(t.split()): i for i, t in rows if i >= 36 and i % 2 == 0}
    assert small[8] in got and small[8] + 1 not in got  # sets of 4 and 5 shingles


@pytest.mark.parametrize("frequent", [64, 1])
def test_jaccard_join_at_80_percent(spark, frequent):
    rows = near_rows()
    got = jaccard_join.link(spark.createDataFrame(rows, "doc_id bigint, text string"), words=5, percent=80, frequent=frequent).collect()
    assert {r.doc_id: r.component_id for r in got} == five_word_groups(rows)


@pytest.mark.parametrize(("percent", "least"), [(85, 6), (80, 4), (50, 1), (90, 9)])
def test_least_size_of_a_set_that_links(percent, least):
    assert jaccard_join._least_size(percent) == least


def test_lines_stage_removes_exact_repeats_of_short_lines(spark):
    long = "a line that is longer than twenty characters"
    rows = [
        (1, f"Read more\n\n{long}\nshort one", "a"), (2, f"own words here\nRead more\n\nRead mor\n{long}x", "b"), (3, "Read more", "c"),
        (4, "  \nRead more\n  \nlast\nlast", "d"), (5, None, "e"), (6, "", "f"), (7, "Read more \n}\n}", "g"), (8, " \n\n", "h"),
    ]
    docs = spark.createDataFrame([(i, t, s, len(t or "")) for i, t, s in rows], "doc_id bigint, text string, source string, n_chars bigint")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines_stage(spark, docs, "").collect()}
    # a near short line ("Read mor") is new, blank lines stay, a document of repeats alone goes
    want = {1: rows[0][1], 2: "own words here\n\nRead mor", 4: "  \n  \nlast", 5: None, 6: "", 7: "Read more \n}", 8: " \n\n"}
    assert got == want


def test_lines_query_removes_exact_repeats_of_short_lines(spark):
    docs = spark.createDataFrame([(1, "Read more\nRead more\n\n\n  \n  ")], "doc_id bigint, text string")
    assert lines.dedup(docs).first().n_removed == 1


@pytest.mark.parametrize("before", [[], [""], [" "], [None, "\n\t"], ["x"], ["longer words before it"]])
def test_a_words_hash_does_not_depend_on_what_stands_before_it(before):
    for text in ("one two three four five", "  one two three four five", "\n\n one\ttwo three  four five \n"):
        assert list(shingles.shingle_sets([*before, text], 3))[-1].tolist() == list(shingles.shingle_sets(["one two three four five"], 3))[0].tolist()
        held = [(t or "").encode() for t in (*before, text)]
        buf = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
        assert shingles.word_hashes(buf)[1][-5:].tolist() == shingles.word_hashes(np.frombuffer(b"one two three four five", np.uint8))[1].tolist()


def grams_of(text):
    return licences.bigrams(np.frombuffer(text.encode(), np.uint8))[1]


def best_dice(grams, own):
    """The highest Dice of any window, by brute force."""
    best = 0.0
    for i in range(len(grams)):
        w = set()
        for g in grams[i:]:
            w.add(g)
            best = max(best, 2 * len(w & own) / (len(w) + len(own)))
    return best


@pytest.mark.parametrize("share", [0.1, 0.12, 0.14, 0.3])
def test_licence_with_inserted_words_inside_a_long_text(share):
    rng = random.Random(11)
    found = 0
    for size in (40, 60):
        for _ in range(5):
            template = [f"t{rng.randrange(10**6)}" for _ in range(size + 1)]
            notice = list(template)
            for _ in range(round(share * size)):
                notice.insert(rng.randrange(1, len(notice)), f"i{rng.randrange(10**6)}")
            around = [f"o{rng.randrange(10**6)}" for _ in range(200)]
            text = " ".join(around[:100] + notice + around[100:])
            known = licences.Templates({"T": " ".join(template)})
            want = best_dice(grams_of(text).tolist(), set(known.sets[0].tolist()))
            got = known.best(grams_of(text))
            assert [r[1] for r in got] == ([pytest.approx(want)] if want >= 0.8 else [])
            found += len(got)
    assert found == (10 if share < 0.14 else found) and (share < 0.3 or found == 0)


def test_licence_windows_equal_brute_force_where_bigrams_repeat():
    rng = random.Random(12)
    for _ in range(150):
        vocab = [f"v{i}" for i in range(rng.choice([4, 12, 60]))]
        template = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 20]))]
        words = [rng.choice([*vocab, "x"]) for _ in range(rng.randrange(40))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = template[:4] + ["ins"] * rng.randrange(2) + template[4:]
        known, grams = licences.Templates({"T": " ".join(template)}), grams_of(" ".join(words))
        want = best_dice(grams.tolist(), set(known.sets[0].tolist()))
        assert [r[1] for r in known.best(grams)] == ([pytest.approx(want)] if want >= 0.8 else [])


def test_licence_of_the_last_text_with_words_before_empty_rows(spark):
    for behind in ([], [None], ["", " \n"], [None, "one"], ["!!!"]):
        rows = list(enumerate(["All rights reserved.", *behind]))
        got = licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
        assert {r.doc_id: r.licence for r in got} == {i: "All-rights-reserved" if i == 0 else None for i, _ in rows}


def test_scan_equals_brute_force_whatever_stands_beside_a_row(spark):
    rng = random.Random(13)
    vocab = [f"v{i}" for i in range(30)]
    templates = {f"T{k}": " ".join(rng.choice(vocab) for _ in range(n)) for k, n in enumerate((2, 3, 6, 12, 25))}
    texts = [None, "", " ", "one", "!!!", "v1 v2"]
    for _ in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randrange(12))]
        at = rng.randrange(len(words) + 1)
        own = rng.choice(list(templates.values())).split()
        words[at:at] = own[: rng.randrange(len(own) // 2, len(own) + 1)]
        texts.append(rng.choice(["{}", "{}\n", " {}.", "{} !"]).format(" ".join(words)))
    sets = {k: set(grams_of(t).tolist()) for k, t in templates.items()}

    def best(text):
        found = {k: best_dice(grams_of(text or "").tolist(), s) for k, s in sets.items()}
        return {k: d for k, d in found.items() if d >= 0.8}

    for seed in range(3):
        rows = [(i, t) for i, t in enumerate(texts)]
        random.Random(seed).shuffle(rows)
        got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), templates).collect()}
        for i, t in rows:
            want = best(t)
            assert {x.licence: x.dice for x in got[i].licences} == pytest.approx(want), t
            assert got[i].n_licences == len(want) and got[i].dice == (pytest.approx(max(want.values())) if want else None)


def test_whole_licences_are_found_inside_other_text():
    known = licences.Templates(licences.TEMPLATES)
    for name in ("Apache-2.0-text", "BSD-3-Clause", "LGPL-3.0-text", "MPL-2.0-text"):
        words = licences.TEMPLATES[name].split()
        changed = " ".join(w for i, w in enumerate(words) if i % 40)
        found = {r[0]: r[1] for r in known.best(grams_of(f"some code before it {changed} and other words behind it"))}
        assert found[name] > 0.9
    assert ("GPL-2.0-text", 1.0) in [r[:2] for r in known.best(grams_of(licences.TEMPLATES["GPL-2.0-text"]))]


def test_crowds_of_pieces_are_cut_into_windows(spark, monkeypatch):
    from test_llm_operators import brute_repeats

    monkeypatch.setattr(repeats, "HOT", 2)
    monkeypatch.setattr(repeats, "CROWD", 3)
    called, whole = [], repeats._single_windows
    monkeypatch.setattr(repeats, "_single_windows", lambda groups: called.append(1) or whole(groups))
    rng = random.Random(21)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    core, ends = text(194), [text(20) for _ in range(6)]
    rows = [(i, text(rng.randrange(0, 60)) + rng.choice(ends)[rng.randrange(12) :] + core + rng.choice(ends)[: rng.randrange(12)] + text(rng.randrange(0, 60))) for i in range(40)]
    rows += [(100, "short"), (101, None), (102, core + core), (103, core * 3 + text(9))]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert called and got == brute_repeats([(i, t or "") for i, t in rows])
