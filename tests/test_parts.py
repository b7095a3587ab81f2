"""Small operators, each on a few rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import arrays, text
from tidemark.operators import alerts, dedupe, filters, forms, lookup, market, positions, reconcile


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def test_attachment_links(spark):
    att = F.array(F.struct(F.lit(" A.pdf").alias("filename"), F.lit("http://x/a").alias("url")), F.struct(F.lit("b.pdf").alias("filename"), F.lit("").alias("url")))
    link = lambda n: one(spark, alerts.attachment_link(att, F.lit(n), F.lit("main")))
    assert [link("a.PDF "), link("b.pdf"), link("c.pdf"), link(""), link(None)] == ["http://x/a", "main", "main", "main", "main"]


@pytest.mark.parametrize(("name", "code", "differs"), [("ABCD.JK", "abcd", False), ("ABCD.JK", "ABCE", True), ("ABCD", "ABCD.JK", False), ("ABCD", None, False), ("ABCD", "not a code", False)])
def test_symbol_mismatch(spark, name, code, differs):
    assert one(spark, alerts.symbol_mismatch(F.lit(name), F.lit(code).cast("string"))) is differs


def test_parser_alerts(spark):
    found = spark.createDataFrame([("a.pdf", "symbol_missing"), ("B.pdf", "symbol_name_mismatch"), ("c.pdf", "own_code")], "filename string, code string")
    docs = spark.createDataFrame([("A.pdf", "t1", "AAAA", "2024-01-01", "m1", []), ("a.pdf", "t2", "AAAA", "2024-01-02", "m2", []), ("b.pdf", "t3", "BBBB", "2024-01-01", "m3", [("b.pdf", "u3")])], "filename string, title string, company_name string, date string, main_link string, attachments array<struct<filename:string,url:string>>")
    got = {r.filename: r for r in alerts.parser_alerts(found, docs).collect()}
    assert (got["a.pdf"].title, got["a.pdf"].url, got["a.pdf"].category, got["a.pdf"].needs_review, got["a.pdf"].stage) == ("t2", "m2", "not_inserted", True, "parser")
    assert (got["B.pdf"].url, got["B.pdf"].category, got["B.pdf"].severity) == ("u3", "inserted", "warning")
    assert (got["c.pdf"].title, got["c.pdf"].message) == (None, "own_code")


def test_short_numbers(spark):
    assert one(spark, text.abbreviated_idr(F.lit(1.5e12))) == "IDR 1.5T" and one(spark, text.abbreviated_idr(F.lit(None).cast("double"))) == "IDR -"
    assert one(spark, text.percent_text(F.lit(2.5))) == "2.50" and one(spark, text.percent_text(F.lit(None).cast("double"))) == "-"
    assert one(spark, text.title_words(F.lit(" oil & GAS  COAL mining"))) == "Oil & GAS Coal Mining" and one(spark, text.title_words(F.lit(None).cast("string"))) == ""


def test_numbers_pairs_and_lists(spark):
    assert one(spark, arrays.first_numbers(F.lit("99 lots, 1.500 then 2,000 and 100 200 300 400"))) == [1500, 2000, 100, 200, 300]
    none_d, none_l = F.lit(None).cast("array<double>"), F.lit(None).cast("array<bigint>")
    raw = F.lit('{"prices":[10,0,20],"amount_transacted":[5,6,7]}')
    pairs = lambda *a: [tuple(x) for x in one(spark, arrays.prices_and_amounts(*a))]
    assert pairs(raw, none_d, none_l, F.lit(1.0), F.lit(2)) == [(10.0, 5), (20.0, 6)]
    assert pairs(F.lit(None).cast("string"), F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(9)).cast("array<bigint>"), F.lit(1.0), F.lit(2)) == [(3.0, 9)]
    assert pairs(F.lit("x"), none_d, none_l, F.lit(1.0), F.lit(2)) == [(1.0, 2)]
    items = lambda *a: F.array(*[F.struct(F.lit(t).alias("type"), F.lit(n).alias("count")) for t, n in a])
    assert one(spark, arrays.stable_json(items(("b", 1), ("a", 2)))) == one(spark, arrays.stable_json(items(("a", 2), ("b", 1)))) == '[{"type":"a","count":2},{"type":"b","count":1}]'
    assert one(spark, arrays.merged_symbols(F.array(F.lit(" b"), F.lit("A"), F.lit("")), F.array(F.lit("a"), F.lit("c")), F.lit(None).cast("array<string>"))) == ["A", "B", "C"]


def test_latest_close_fills_what_has_no_series(spark):
    prices = spark.createDataFrame([("A", "2024-01-01", 10.0, None), ("A", "2024-01-02", 20.0, None), ("B", "2024-01-01", None, None)], "symbol string, date string, close double, vwap double").withColumn("date", F.col("date").cast("date"))
    ref = market.market_reference(prices, "2024-01-10")
    latest = spark.createDataFrame([("A", 99.0, "2024-01-05"), ("B", 7.0, "2024-01-04"), ("C", 3.0, "2024-01-03"), ("C", 4.0, "2024-01-08"), ("D", None, "2024-01-08")], "symbol string, close double, date string")
    got = {r.symbol: (r.ref_price, r.ref_type, str(r.asof_date), r.n_days, r.freshness_days) for r in market.with_latest_close(ref, latest, "2024-01-10").collect()}
    assert got == {"A": (15.0, "close_median", "2024-01-02", 2, 8), "B": (7.0, "close", "2024-01-04", 1, 6), "C": (4.0, "close", "2024-01-08", 1, 2)}


def test_chunks_names_and_keys(spark):
    a, b = spark.createDataFrame([(1, " x ")], "id int, name string"), spark.createDataFrame([("x", 2.0), ("", 1.0), (None, 1.0)], "name string, v double")
    both = filters.in_source_order(a, b)
    assert [(r.src_seq, r.id, r.v) for r in both.orderBy("src_seq", "v").collect()] == [(0, 1, None), (1, None, 1.0), (1, None, 1.0), (1, None, 2.0)]
    assert [r.name for r in filters.distinct_names(both, "name").collect()] == ["x"]
    assert tuple(one(spark, reconcile.match_key(F.lit(" t "), F.lit(" ab"), True))) == ("t", "AB") and one(spark, reconcile.match_key(F.lit("t"), F.lit("ab"), False)).sym == ""
    assert [one(spark, reconcile.json_or_null(F.lit(x))) for x in ("[1]", "x", "")] == ["[1]", None, None]


def test_computed_values(spark):
    rows = spark.createDataFrame([(1, 10, 4, 0.0), (2, None, 4, 0.0)], "f int, holding_before int, holding_after int, price double")
    tx = spark.createDataFrame([(1, "sell", 5.0, 8, 40.0), (1, "buy", 5.0, 2, 10.0)], "f int, type string, price double, amount int, value double")
    got = {r.f: r for r in positions.attach_computed(rows, tx, "f").collect()}
    assert (got[1].price, got[1].transaction_value, got[1].transaction_type, got[1].amount_transaction) == (5.0, 30.0, "sell", 6)
    assert (got[2].price, got[2].amount_transaction) == (None, None)


def test_title_reporter_and_rows(spark):
    t = "x\n Laporan Kepemilikan Efek 5%\nBAE : PT Biro\n"
    assert tuple(one(spark, forms.title_and_reporter(F.lit(t)))) == ("Laporan Kepemilikan Efek 5%", "PT Biro") and tuple(one(spark, forms.title_and_reporter(F.lit("z")))) == ("", "UNKNOWN")
    df = spark.createDataFrame([("f", [(1, 2), (3, 4)]), ("g", [])], "file string, rows array<struct<a:int,b:int>>")
    assert [tuple(r) for r in forms.flattened(df).orderBy("a").collect()] == [("f", 1, 2), ("f", 3, 4)]


def test_ties_do_not_decide_by_chance(spark):
    companies = spark.createDataFrame([("ABCD", "old"), ("ABCD.JK", "new"), ("EF", "b"), ("EF", "a")], "symbol string, name string")
    rows = spark.createDataFrame([("ABCD",), ("EF.JK",), ("X",)], "symbol string")
    assert {r.symbol: r.name for r in lookup.company_join(rows, companies).collect()} == {"ABCD": "new", "EF.JK": "b", "X": None}
    assert [tuple(r) for r in lookup.latest_row(spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, None, "z")], "k int, o int, v string"), "k", "o").collect()] == [(1, 5, "b")]


def test_fields_of_a_hash_do_not_run_together(spark):
    h = lambda a, b: one(spark, dedupe.filing_hash([F.lit(a), F.lit(b)], [], F.lit("2024-01-01")))
    assert len({h("a|b", "c"), h("a", "b|c"), h("a\\", "|b"), h("a\\|", "b")}) == 4 and h(" A", "b") == h("a", "B ")


def test_size_budget_over_all_rows_is_that_of_one_group(spark):
    import random

    rng = random.Random(3)
    rows = spark.createDataFrame([(i, rng.randrange(0, 50), 1) for i in range(400)], "id int, size int, g int").repartition(5)
    want = sorted(tuple(r) for r in filters.size_budget(rows, "size", 900, "id", ["g"]).collect())
    got = sorted(tuple(r) for r in filters.size_budget(rows, "size", 900, "id").select("id", "size", "g", "running").collect())
    assert got == want and 0 < len(got) < 400
    assert filters.size_budget(rows.limit(0), "size", 900, "id").count() == 0


def test_symbols_are_resolved_in_order(spark):
    companies = spark.createDataFrame([("ADRO", "PT Adaro Energy Tbk"), ("ADRO.JK", "PT Adaro Energy Tbk"), ("BBCA.JK", "PT Bank Central Asia Tbk"), ("TLKM.JK", "PT Telkom Indonesia (Persero) Tbk")], "symbol string, company_name string")
    rows = [
        (1, "see TLKM", "Bank Central Asia", "ADRO"), (2, "see TLKM", "Bank Central Asia Tbk", "XXXX"), (3, "see TLKM", "Bank Centrall Asia", None),
        (4, "holder of PT Adaro Energi Tbk, TLKM", "Somebody", None), (5, "ABC then TLKM", None, None), (6, "none", "Nobody At All", None), (7, None, None, None),
    ]
    got = {r.id: (r.symbol, r.display_name) for r in lookup.resolve(spark.createDataFrame(rows, "id int, text string, name string, code string"), "id", "text", "name", companies, "code").collect()}
    assert {i: s for i, (s, _) in got.items()} == {1: "ADRO", 2: "BBCA.JK", 3: "BBCA.JK", 4: "ADRO.JK", 5: "TLKM.JK", 6: None, 7: None}
    assert got[3][1] == "PT Bank Central Asia Tbk" and got[6][1] == "Nobody At All"


def test_uploads_stop_and_alert(spark):
    from tidemark.sources import writers

    def send(row):
        if row["symbol"] == "b":
            raise ValueError("refused")

    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "symbol string").coalesce(1)
    assert [(r.ok, r.error) for r in writers.upload(rows, send).collect()] == [(True, None), (False, "refused"), (True, None)]
    sent = writers.upload(rows, send, stop_on_first_error=True)
    assert [(r.ok, r.error) for r in sent.collect()] == [(True, None), (False, "refused"), (False, "not sent")]
    assert [r.message for r in writers.upload_alerts(sent, "filings").collect()] == ["filings: refused", "filings: not sent"]
    assert writers.is_stale(1, 1, 0, checksum="a", cached_checksum="b") and not writers.is_stale(1, 1, 0)


def test_actions_groups_and_links(spark):
    from tidemark.operators import articles

    act = lambda code, stage, cat: one(spark, alerts.action(F.lit(code), F.lit(stage), F.lit(cat)))
    assert act("symbol_missing", "parser", "not_inserted") == alerts.MANUAL and act("symbol_missing", "filings", "not_inserted").startswith("Confirm")
    assert act("stale_price", "filings", "inserted").startswith("Fetch") and act("other", "filings", "inserted") == alerts.REVIEW
    tx = lambda kind, why: F.struct(F.lit(kind).alias("type"), F.lit(1.0).alias("price"), F.lit(why).alias("purpose"))
    got = one(spark, forms.split_groups(F.array(tx("buy", "a"), tx("others", "b"), tx("sell", "c"), tx("koreksi", "d"))))
    assert (got.others.purpose, [t.type for t in got.others.price_transaction]) == ("b", ["others"])
    assert (got.trades.purpose, [tuple(t) for t in got.trades.price_transaction]) == ("c", [("buy", 1.0), ("sell", 1.0)])
    assert one(spark, forms.split_groups(F.array(tx("others", "b")))).trades is None
    link = lambda a, b: one(spark, articles.document_link(F.lit(a), F.lit(b).cast("string"), F.lit("src")))
    assert [link("https://x/a.PDF?d=1", "i"), link("https://x/a", "i"), link("a.pdf", None), link("https://x/a", "")] == ["https://x/a.PDF?d=1", "i", "src", "src"]
