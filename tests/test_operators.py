import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import alerts, audit, dedupe, filters, lookup, market, positions, reconcile

TX = "filing_id int, type string, price double, amount bigint, value decimal(18,2), date string"


def rows_of(doc, *txs):
    return [(doc, t, p, a, None if p is None or a is None else round(p * a, 2), "2025-12-18") for t, p, a in txs]


GOLDEN = rows_of(2, ("sell", 54.0, 757100), ("buy", 50.0, 35200000), ("sell", 53.0, 1000000), ("sell", 53.0, 2000000), ("sell", 54.0, 1000000), ("sell", 55.0, 1000000), ("sell", 56.0, 1000000), ("sell", 54.0, 449500))


@pytest.fixture(scope="module")
def golden(spark):
    from decimal import Decimal

    fix = lambda r: (*r[:4], None if r[4] is None else Decimal(str(r[4])), r[5])
    return spark.createDataFrame([fix(r) for r in GOLDEN], TX)


def test_golden_document(golden):
    assert positions.document_median(golden, "filing_id").first().doc_median == 54
    net = positions.net_position(golden, "filing_id").first()
    assert (net.net_type, net.net_value, net.net_shares, round(net.net_price, 2)) == ("buy", 1370843600, 27993400, 48.97)


def test_percent_model(spark):
    df = spark.createDataFrame([(15681559, 15681059, 2.561, 2.561, -500), (0, 27993400, 0.0, 0.29, 27993400), (None, None, None, None, 5)], "holding_before bigint, holding_after bigint, share_percentage_before double, share_percentage_after double, net_signed bigint")
    a, b, c = positions.percent_model(df).collect()
    assert (round(a.total_shares_model, 6), a.delta_pp_model, a.pp_after_model, a.percent_discrepancy) == (612321710.269426, -0.001, 2.56, False)
    assert (b.delta_pp_model, b.discrepancy_pp) == (0.29, 0)
    assert c.total_shares_model is None and c.percent_discrepancy is False


def test_audit_reasons_and_gate(spark):
    schema = "id int, freshness_days int, ref_price double, amount_transaction bigint, holding_before bigint, holding_after bigint, price double, transaction_value double, transaction_type string, txs array<struct<date:string,type:string,price:double,amount:bigint>>, doc_median double, percent_discrepancy boolean, discrepancy_pp double"
    t = lambda *x: [("2025-01-01", k, p, a) for k, p, a in x]
    df = spark.createDataFrame(
        [
            (1, 1, 100.0, 5, 10, 15, 100.0, 500.0, "buy", t(("buy", 100.0, 5)), 100.0, False, 0.0),
            (2, 20, 100.0, None, 10, 5, 100.0, 500.0, "buy", t(("buy", 1000.0, 5), ("transfer", 100.0, 5)), 100.0, False, 0.0),
            (3, None, None, 5, 10, 15, 100.0, 500.0, "buy", [], None, True, 0.5),
            (4, 1, 100.0, 5, 10, 15, 100.0, 500.0, "others", t(("transfer", 100.0, 5)), 100.0, False, 0.0),
        ],
        schema,
    )
    got = {r.id: ([x.code for x in r.reasons], r.skip_reason) for r in audit.audit(df).collect()}
    assert got[1] == ([], None)
    assert got[2][0] == ["stale_price", "missing_required_field", "mismatch_transaction_type", "mixed_transaction_type", "price_deviation_within_doc", "price_deviation_vs_market", "possible_zero_missing"]
    assert got[2][1] == "mixed_transaction_type"
    assert got[3] == (["missing_price", "invalid_price_transaction", "percent_discrepancy"], "missing_price")
    assert got[4] == (["transfer_only_transaction"], "transfer_only_transaction")


def test_market_reference_falls_back(spark):
    d = lambda i: dt.date(2026, 1, i)
    df = spark.createDataFrame([("a", d(1), 10.0, 11.0), ("a", d(2), 20.0, 21.0), ("b", d(1), 10.0, None), ("b", d(2), 20.0, None), ("b", d(3), 40.0, None)], "symbol string, date date, close double, vwap double")
    got = {r.symbol: (r.ref_price, r.ref_type, r.n_days, r.freshness_days) for r in market.market_reference(df, "2026-01-05", 2).collect()}
    assert got == {"a": (16.0, "vwap_mean", 2, 3), "b": (30.0, "close_median", 2, 2)}


def test_alias_lookup_prefers_exact_then_basename_and_last(spark):
    docs = spark.createDataFrame([(1, "https://x/a.pdf"), (2, "https://y/a.pdf"), (3, "https://z/b.pdf")], "seq int, url string")
    index = lookup.alias_index(docs, "url", "seq")
    left = spark.createDataFrame([(1, "https://x/a.pdf"), (2, "a.pdf"), (3, "b"), (4, "nope"), (5, None)], "id int, source string")
    got = {r.id: r.seq for r in lookup.alias_join(left, "id", ["source"], index, ["seq"]).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: None, 5: None}


def test_resolve_cascade(spark):
    companies = spark.createDataFrame([("AKPI.JK", "PT Argha Karya Tbk"), ("MAXI.JK", "Maxindo Karya")], "symbol string, company_name string")
    rows = spark.createDataFrame([(1, "", "ARGHA KARYA"), (2, "see THE and MAXI", "x"), (3, "none", "pt foo tbk")], "id int, text string, name string")
    got = {r.id: (r.symbol, r.display_name) for r in lookup.resolve(rows, "id", "text", "name", companies).collect()}
    assert got == {1: ("AKPI.JK", "PT Argha Karya Tbk"), 2: ("MAXI.JK", "Maxindo Karya"), 3: (None, "PT Foo Tbk")}


def test_batch_dedupe(spark):
    df = spark.createDataFrame([(1, "k", False, "2025"), (2, "k", True, "2024"), (3, "k", False, None), (4, None, False, ""), (5, None, False, "")], "seq int, key string, edited boolean, created string")
    got = {r.seq: r.skip_reason for r in dedupe.batch_dedupe(df, ["key"], F.col("edited"), F.col("created"), ["seq"]).collect()}
    assert got == {1: "duplicate_in_batch", 2: None, 3: "duplicate_in_batch", 4: None, 5: "duplicate_in_batch"}


def test_cascade_treats_nulls_as_equal(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", "z")], "old int, x string, y string")
    new = spark.createDataFrame([(10, "a", None), (11, "b", "q"), (12, "c", "z")], "new int, x string, y string")
    got = {(r.new, r.old, r.key_no) for r in reconcile.cascade_match(old, "old", new, "new", [["x", "y"], ["x"]], "old").collect()}
    assert got == {(10, 2, 0), (11, 3, 1)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 2), st.sampled_from([None, "d"])), max_size=12), st.lists(st.tuples(st.integers(1, 3), st.integers(1, 2)), max_size=12))
def test_fifo_against_queue(spark, stored, source):
    a = [(i, p, q, d) for i, (p, q, d) in enumerate(stored)]
    b = [(i, p, q, f"s{i}") for i, (p, q) in enumerate(source)]
    schema = "pos int, price int, amount int, date string"
    got = reconcile.fifo_dates(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["price", "amount"], ["pos"]).collect()
    queue = {}
    for _, p, q, d in b:
        queue.setdefault((p, q), []).append(d)
    want = {i: d or (queue.get((p, q)) or [None]).pop(0) if not d and queue.get((p, q)) else d for i, p, q, d in a}
    assert {r.pos: r.date for r in got} == want


def test_fifo_wildcard(spark):
    schema = "k int, pos int, type string, price double, amount bigint, date string"
    a = spark.createDataFrame([(1, 0, "unknown", 1.0, 5, None), (1, 1, "buy", 1.0, 5, None), (2, 0, "sell", 1.0, 5, None)], schema)
    b = spark.createDataFrame([(1, 0, "buy", 1.0, 5, "d1"), (1, 1, "sell", 1.0, 5, "d2")], schema)
    got = {(r.k, r.pos): (r.type, r.date) for r in reconcile.fifo_wildcard(a, b, "k").collect()}
    assert got == {(1, 0): ("sell", "d2"), (1, 1): ("buy", "d1"), (2, 0): ("sell", None)}


def test_multiset_diff(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert {tuple(r) for r in reconcile.multiset_diff(a, b, ["x"]).collect()} == {(1, 1, 0), (2, 1, 0), (3, 0, 1)}


def test_announcements(spark):
    schema = "Title string, Code string, PublishDate string, Attachments array<struct<FullSavePath:string,OriginalFilename:string>>"
    df = spark.createDataFrame([("T 1", "AKPI", "2025-12-18T11:28:08", [("https://x/LK-1.PDF", "a"), ("https://x/b.pdf", None), ("ftp", "c")]), ("T 2", "B", "x", []), ("T 3", "C", "x", [("ftp://x", "a")])], schema)
    (r,) = filters.announcements(df).collect()
    assert (r.filename, r.title_slug, r.attachment_count, r.attachments[0].filename) == ("lk-1.pdf", "t-1", 1, "b.pdf")


def test_alert_defaults_and_flatten(spark):
    df = spark.createDataFrame([("stale_price", None, None), ("odd", None, "own")], "code string, severity string, message string")
    got = {r.code: (r.severity, r.message) for r in alerts.with_defaults(df).collect()}
    assert got["stale_price"][0] == "soft" and got["odd"] == ("warning", "own")
    rs = spark.createDataFrame([(1, [("tx", "a", "m1"), ("row", "b", "m2")])], "id int, reasons array<struct<scope:string,code:string,message:string>>")
    assert alerts.flatten(rs).first().reason_code == "b"


def test_required_and_window(spark):
    df = spark.createDataFrame([("a", "t", "", "0")], "symbol string, timestamp string, holder_name string, transaction_type string")
    assert df.select(filters.missing_columns()).first()[0] == ["holder_name", "transaction_type"]
    assert df.select(filters.in_window(F.lit(5), None, F.lit(3))).first()[0] is True


def test_transform_of_canonical_rows_is_idempotent(spark):
    from tidemark.operators import tags

    df = spark.createDataFrame([(["mesop", "x"], "buy")], "t array<string>, ty string")
    once = df.withColumn("t", tags.record_tags(F.col("t"), F.col("ty")))
    assert once.collect() == once.withColumn("t", tags.record_tags(F.col("t"), F.col("ty"))).collect()


def test_nearest_names_are_those_of_scoring_all(spark, monkeypatch):
    import random

    from tidemark.functions.text import company_key
    from tidemark.operators import fuzzy

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abdeiklnorstu") for _ in range(rng.randrange(2, 8))).title()
    names = [f"PT {' '.join(word() for _ in range(rng.randrange(1, 4)))} Tbk." for _ in range(150)]
    dim = spark.createDataFrame([(f"S{i:03d}{'.JK' if i % 2 else ''}", n) for i, n in enumerate(names)] + [("S000.JK", names[0]), ("S900", None), (None, "PT Nobody Tbk")], "symbol string, company_name string")

    def typo(n):
        x = list(n)
        for _ in range(rng.randrange(0, 3)):
            x[rng.randrange(3, len(x))] = rng.choice("aeiou")
        return "".join(x)

    rows = [(i, typo(rng.choice(names))) for i in range(80)] + [(900, None), (901, "PT Tbk"), (902, "Ádaro")]
    left = spark.createDataFrame(rows, "id int, said string")
    key = lambda x: [r[0] for r in spark.createDataFrame([(v,) for v in x], "v string").select(company_key(F.col("v"))).collect()]
    listed = [(s, k) for s, k in zip(dim.toPandas()["symbol"], key(dim.toPandas()["company_name"].tolist()), strict=True) if s and k]
    want = {}
    for (i, _), q in zip(rows, key([n for _, n in rows]), strict=True):
        top = {}
        for s, k in listed:
            score = fuzzy._ratio(q, k)
            base = s.removesuffix(".JK")
            if q and (base not in top or (-score, not s.endswith(".JK"), s) < (-top[base][0], not top[base][1].endswith(".JK"), top[base][1])):
                top[base] = (score, s)
        want[i] = [(s, x) for x, s in sorted(top.values(), key=lambda t: (-t[0], t[1]))[:3]]

    def got(df):
        out = {i: [] for i in want}
        for r in df.orderBy("id", "rank").collect():
            out[r.id].append((r.symbol, r.score))
        return out

    assert got(fuzzy.nearest(left, "id", "said", dim, "symbol", "company_name")) == want
    best = {r.id: r.symbol for r in fuzzy.best_match(left, "id", "said", dim, "symbol", "company_name").collect()}
    assert best == {i: w[0][0] for i, w in want.items() if w and w[0][1] >= 85}
    # beyond the list's bound: blocks of word heads, which nearly all names that are near share
    monkeypatch.setattr(fuzzy, "LIST_ROWS", 10)
    blocked = {r.id: r.symbol for r in fuzzy.best_match(left, "id", "said", dim, "symbol", "company_name").collect()}
    assert sum(blocked.get(i) == s for i, s in best.items()) >= 0.9 * len(best)
