"""Parsed rows to canonical records: one announcement's rows as stored before and after."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import records

LINK = "https://example.org/From_KSEI/LK-1-00.pdf-0.pdf"
SOLD = {
    "holding_before": 15681559, "holding_after": 15681059, "share_percentage_before": 2.561, "share_percentage_after": 2.561, "share_percentage_transaction": 0.0, "symbol": "AKPI.JK",
    "company_name": "Argha Karya Prima Ind. Tbk", "holder_name": "Henry Liem", "price_transaction": [{"type": "sell", "amount_transacted": 500, "price": 580, "date": "2025-12-17"}],
    "purpose": "Jual saham", "price": 580.0, "transaction_value": 290000, "transaction_type": "sell", "amount_transaction": 500, "source": LINK, "tags": ["divestment"], "holder_type": "insider", "timestamp": "2025-12-18 10:02:06",
}


def one(spark, raw, **more):
    text = raw if isinstance(raw, str) or raw is None else json.dumps(raw)
    return records.canonical_records(spark.createDataFrame([(1, text)], "id int, raw string"), **more).first()


def test_stored_pair(spark):
    dim = spark.createDataFrame([("AKPI", "Basic Materials", "Basic Materials")], "symbol string, sector string, sub_sector string")
    r = one(spark, SOLD, companies=dim, translate=lambda x: F.when(x == "Jual saham", "Sell shares"))
    assert (r.symbol, r.timestamp, r.transaction_type, r.amount_transaction, r.price, r.transaction_value) == ("AKPI.JK", "2025-12-18T10:02:06", "sell", 500, 580.0, 290000.0)
    assert (r.holding_before, r.holding_after, r.share_percentage_before, r.share_percentage_transaction) == (15681559, 15681059, 2.561, 0.0)
    assert r.title == "Henry Liem sells shares of Argha Karya Prima Ind. Tbk"
    assert r.body == "Henry Liem sold 500 shares of Argha Karya Prima Ind. Tbk. This decreases their holdings from 15,681,559 to 15,681,059 shares. The stated purpose of the transaction was sell shares."
    assert [tuple(t) for t in r.price_transaction] == [("2025-12-17", "sell", 580.0, 500)]
    assert (r.tags, r.sector, r.sub_sector, r.source, r.holder_type, r.needs_manual_uid) == (["divestment"], "basic-materials", "basic-materials", LINK, "insider", False)


def test_numbers_come_from_transactions_where_the_row_has_none(spark):
    raw = {"symbol": "maxi", "transactions": [{"type": "buy", "amount": 300, "price": "1,000", "date": "20251104"}, {"type": "Sell", "amount": 100, "price": 600}, {"type": "transfer", "amount": 5, "price": 1}], "holding_before": 0, "holding_after": 10, "date": "2025-12-18T11:28:08", "purpose": "Investasi pribadi"}
    r = one(spark, raw)
    assert (r.amount_transaction, r.price, r.transaction_value) == (400, 900.0, 360000.0)
    assert [t.date for t in r.price_transaction] == ["2025-11-04", "2025-12-18", "2025-12-18"]
    assert (r.symbol, r.transaction_type, r.company_name, r.holder_name, r.purpose_of_transaction, r.sector) == ("MAXI.JK", "buy", "maxi", "Unknown Shareholder", "investment", "unknown")


def test_blocks_of_parallel_arrays_take_the_day_of_publication(spark):
    raw = {"price_transaction": {"prices": [10, 20], "amount_transacted": [1, 2], "type": "buy"}, "timestamp": "20240105", "transaction_type": "share-transfer"}
    r = one(spark, raw)
    assert [tuple(t) for t in r.price_transaction] == [("2024-01-05", "buy", 10.0, 1), ("2024-01-05", "buy", 20.0, 2)]
    assert r.needs_manual_uid and r.timestamp == "2024-01-05T00:00:00" and r.tags == ["share-transfer"]


def test_a_file_name_is_resolved_by_its_aliases(spark):
    docs = spark.createDataFrame([(LINK, "lk-1-00.pdf-0.pdf", "2025-12-18T10:02:06"), ("https://example.org/other.pdf", "other.pdf", "2024-01-01T00:00:00")], "main_link string, filename string, date string")
    for source in ("downloads/lk-1-00.pdf-0.pdf", "lk-1-00.pdf-0", LINK):
        r = one(spark, {"source": source}, documents=docs)
        assert (r.source, r.timestamp) == (LINK, "2025-12-18T10:02:06")
    assert one(spark, {"source": "unknown.pdf", "pdf_url": "https://x.org/y"}, documents=docs).source == "https://x.org/y"


@pytest.mark.parametrize("raw", ["", None, "no json", "[1, 2]", "{}"])
def test_rows_without_fields_give_defaults(spark, raw):
    r = one(spark, raw)
    assert (r.transaction_type, r.holder_name, r.company_name, r.price_transaction, r.symbol, r.source, r.needs_manual_uid) == ("others", "Unknown Shareholder", "Unknown Company", [], None, None, True)


def test_a_record_made_again_is_the_same(spark):
    first = records.canonical_records(spark.createDataFrame([(1, json.dumps(SOLD))], "id int, raw string"))
    again = records.canonical_records(first.select("id", F.to_json(F.struct(*[c for c in first.columns if c != "id"])).alias("raw")))
    assert first.drop("body").first() == again.drop("body").first()


@pytest.mark.parametrize(("said", "english"), [("Transaksi Pribadi/Investasi", "personal transaction"), ("INVESTASI", "investment"), ("program mesop 2024", "mesop"), ("transfer", "share transfer"), ("Jual saham", "Jual saham"), (None, None)])
def test_purposes(spark, said, english):
    assert spark.createDataFrame([(said,)], "p string").select(records.english_purpose(F.col("p"))).first()[0] == english
