import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import arrays, dates, numbers, text
from tidemark.operators import articles, audit, forms, fuzzy, tags


def one(spark, col, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(col).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [("1.234.567,89", 1234567.89), ("1,234,567.89", 1234567.89), ("1.110", 1110), ("106.6", 106.6), ("1,5", 1.5), ("1,500", 1500), ("-", 0), ("", 0), (None, 0), ("16.700", 16700), ("Rp 2.000,-", 0), ("1.234.567", 1234567), ("-1.500", -1500), (".500", 0.5)],
)
def test_locale_number(spark, raw, want):
    assert one(spark, numbers.locale_number(F.col("v")), v=raw) == want


@pytest.mark.parametrize("raw, want", [("0,45%", 0.45), ("5.001", 5.001), ("1.234,567", 1234.567), ("1,234.567", 1234.567), ("1.234.5", 1234.5), ("8,52229999 %", 8.52229), ("-0,000001", -0.00001), ("x", 0), (None, 0)])
def test_locale_percent(spark, raw, want):
    assert one(spark, numbers.locale_percent(F.col("v")), v=raw) == want


@pytest.mark.parametrize("raw, want", [("2.561", 2.561), ("2.5619", 2.561), ("-0.0008", -0.001), ("1.0E-5", 0.0), ("NaN", None), (None, None), ("abc", None)])
def test_floor_places(spark, raw, want):
    assert one(spark, numbers.floor_places(F.col("v")), v=raw) == want


@pytest.mark.parametrize("raw, want", [("1,234.9", 1234), (" -7.9 ", -7), ("x", None), ("", None), ("NaN", None), (None, None)])
def test_to_long(spark, raw, want):
    assert one(spark, numbers.to_long(F.col("v")), v=raw) == want


def test_missing_zero_and_grouping(spark):
    assert one(spark, numbers.missing_zero(F.lit(80.0), F.lit(10.0))) == "x10_candidate"
    assert one(spark, numbers.missing_zero(F.lit(1500.0), F.lit(10.0))) == "x100_candidate"
    assert one(spark, numbers.missing_zero(F.lit(30.0), F.lit(10.0))) is None
    assert one(spark, numbers.missing_zero(F.lit(30.0), F.lit(0.0))) is None
    assert one(spark, numbers.grouped_int(F.lit("1.234.567"))) == 1234567
    assert one(spark, numbers.grouped_int(F.lit("12.5"))) == 12
    assert one(spark, numbers.dash_is_zero(F.lit("—"))) == "0"
    assert one(spark, numbers.close_percent(F.lit("0.29"), F.lit("0.290001"))) is True


@pytest.mark.parametrize("raw, want", [("PT Bank & Co. Tbk.", "BANK AND CO"), ("Perusahaan (Persero) é", "PERUSAHAAN E"), (None, ""), ("PT", "")])
def test_company_key(spark, raw, want):
    assert one(spark, text.company_key(F.col("v")), v=raw) == want


def test_names(spark):
    assert one(spark, text.kebab(F.lit(" Freé  Float Requirement! "))) == "free-float-requirement"
    assert one(spark, text.kebab(F.lit(" -- "))) is None
    assert one(spark, text.holder_name(F.lit("pt maju\nJAYA  tbk."))) == "PT Maju Jaya TBK"
    assert one(spark, text.holder_type(F.lit("Septian"))) == "institution"
    assert one(spark, text.holder_type(F.lit("Budi"))) == "insider"
    assert one(spark, text.holder_type(F.lit(None).cast("string"))) == "insider"
    assert one(spark, text.symbol(F.lit(" akpi "))) == "AKPI.JK"
    assert one(spark, text.symbol(F.lit("akpi.jk"))) == "AKPI.JK"
    assert one(spark, text.stem(F.lit("a/b.pdf-0.pdf"))) == "b.pdf-0"
    assert one(spark, text.safe_filename(F.lit("https://x.id/A B%.c.PDF?x=1#y"))) == "a-b-.c.pdf"
    assert one(spark, text.safe_filename(F.lit(""))) == "file.pdf"
    assert one(spark, text.ticker(F.lit("Report [ABCD] x"), F.lit(""))) == "ABCD"
    assert one(spark, text.escape_html(F.lit("<a & 'b'>"))) == "&lt;a &amp; &#x27;b&#x27;&gt;"
    assert one(spark, text.abbreviated(F.lit(1.5e9))) == "1.5B"
    assert one(spark, text.abbreviated(F.lit(2e6))) == "2M"
    assert one(spark, text.dotted(F.lit(1234567))) == "1.234.567"
    assert one(spark, text.masked(F.lit("081234"))) == "**1234"
    assert one(spark, text.pretty_company(F.lit("pt. astra-graphia TBK"))) == "PT Astra-Graphia Tbk"
    assert one(spark, text.first_filled(F.lit(" "), F.lit(None).cast("string"), F.lit("x"))) == "x"
    assert one(spark, text.truthy_number(F.lit(0), F.lit(5))) == 5


def test_largest_unit(spark):
    assert [one(spark, text.abbreviated(F.lit(x))) for x in (1e12, -2.5e12, 9e14)] == ["1T", "-2.5T", "900T"]
    assert [one(spark, text.abbreviated(F.lit(x), largest="B")) for x in (1e12, -2.5e12, 999.9e9, 2e6)] == ["1000B", "-2500B", "999.9B", "2M"]


def test_dates(spark):
    utc = lambda h, m=0, d=18: dt.datetime(2025, 12, d, h, m, tzinfo=dt.timezone.utc).replace(tzinfo=None)
    at = lambda x: one(spark, F.date_format(dates.publish_time(F.lit(x)), "yyyy-MM-dd HH:mm"))
    assert at("2025-12-18T11:28:08") == utc(4, 28).strftime("%Y-%m-%d %H:%M")
    assert at("2025-12-18T11:28:08Z") == "2025-12-18 11:28"
    assert at("2025-12-18T03:00:00+07:00") == "2025-12-17 20:00"
    assert at("soon") is None
    assert one(spark, dates.iso_date(F.lit("20251218"))) == "2025-12-18"
    assert one(spark, dates.iso_date(F.lit("20251399"))) is None
    assert one(spark, dates.month_name_date(F.lit("Jakarta, 9 Mei 2026."))) == "2026-05-09"
    assert one(spark, dates.month_name_date(F.lit("9 Foo 2026"))) is None
    assert one(spark, dates.short_month_date(F.lit("15-Des-2025"))) == "2025-12-15"
    assert one(spark, dates.short_month_date(F.lit("15-Xyz-2025"))) == "2025-01-15"
    assert one(spark, F.size(dates.time_candidates(F.lit("2025-12-18T04:28:08Z")))) == 3
    assert one(spark, dates.with_z(F.lit("2025-12-18T04:28:08"))) == "2025-12-18T04:28:08Z"
    assert dates.day_window("20251218", "23:00", "01:00") == ("2025-12-18T23:00:00", "2025-12-19T01:00:59")
    assert dates.day_window("20251218", None, "01:00") is None
    assert dates.month_range("202402") == ("2024-02-01", "2024-02-29")


TX = [("buy", 54.0, 757100), ("sell", 50.0, 10)]


@pytest.mark.parametrize(
    "raw",
    [
        '[{"type":"buy","price":54,"amount_transacted":757100,"date":null},{"transaction_type":"sell","transaction_price":"50","amount":10}]',
        '{"prices":[54,50],"amount_transacted":[757100,10],"types":["buy","sell"]}',
        '{"prices":[54,50],"amount_transacted":[757100,10],"type":["buy","sell"]}',
        '[{"date":[],"type":["buy","sell"],"price":[54,50],"amount_transacted":[757100,10]}]',
        '{"date":[null,null],"type":["buy","sell"],"price":["54","50"],"amount_transacted":[757100,10]}',
    ],
)
def test_transaction_shapes(spark, raw):
    got = one(spark, arrays.parse_transactions(F.col("v")), v=raw)
    assert [(t.type, t.price, t.amount) for t in got] == TX


def test_transaction_shapes_without_types_and_bad_ones(spark):
    got = one(spark, arrays.parse_transactions(F.lit('{"prices":[54,50],"amount_transacted":[757100]}')))
    assert [(t.type, t.price, t.amount) for t in got] == [("other", 54.0, 757100), ("other", 50.0, None)]
    assert [t.type for t in one(spark, arrays.parse_transactions(F.lit('{"prices":[1,2],"amount":[3,4],"type":"buy"}')))] == ["buy", "buy"]
    assert one(spark, arrays.parse_transactions(F.lit("not json"))) is None
    assert one(spark, arrays.parse_transactions(F.lit(None).cast("string"))) is None


def test_lists_and_json(spark):
    assert one(spark, arrays.string_list(F.lit('["a"," b",""]'))) == ["a", "b"]
    assert one(spark, arrays.string_list(F.lit("a, b,,c"))) == ["a", "b", "c"]
    assert one(spark, arrays.string_list(F.lit(" "))) is None
    assert one(spark, arrays.name_of(F.lit("{'name': 'X Y'}"))) == "X Y"
    assert one(spark, arrays.name_of(F.lit("plain "))) == "plain"
    assert one(spark, F.size(arrays.rows_of(F.lit('{"alerts":[{"a":1},{"a":2}]}')))) == 2
    assert one(spark, arrays.rows_of(F.lit("{}"))) is None
    assert one(spark, arrays.last_number(F.lit("a 12 b 3.400,5 c"))) == "3.400,5"
    assert one(spark, arrays.attachment_url(F.lit('{"x":1,"href":"https://a/b"}'))) == "https://a/b"


@pytest.mark.parametrize("b, a, loose, strict", [(49.999, 50.0, True, False), (50.0, 49.999, True, False), (49.0, 50.001, True, True), (50.0, 51.0, False, False), (51.0, 49.0, True, True)])
def test_takeover(spark, b, a, loose, strict):
    assert one(spark, tags.crosses_half(F.lit(b), F.lit(a))) is loose
    assert one(spark, tags.crosses_half_strictly(F.lit(b), F.lit(a))) is strict


def test_tags(spark):
    n = F.lit(None).cast("double")
    assert one(spark, tags.document_type(F.lit("Ralat penjualan"), n, n)) == "neutral"
    assert one(spark, tags.document_type(F.lit("jual beli"), n, n)) == "sell"
    assert one(spark, tags.document_type(F.lit("x"), F.lit(1.0), F.lit(2.0))) == "buy"
    assert one(spark, tags.new_form_tags(F.lit("investasi dan divestasi"), n, n, F.lit("buy"))) == ["investment"]
    assert one(spark, tags.new_form_tags(F.lit(""), F.lit(40.0), F.lit(60.0), F.lit("sell"))) == ["divestment", "takeover"]
    assert one(spark, tags.record_tags(F.array(F.lit("Share-Transfer"), F.lit("x")), F.lit("award"))) == ["award"]
    assert one(spark, tags.backfilled_tags(F.array(F.lit("invest"), F.lit("MESOP"), F.lit("idx")), F.lit(1.0), F.lit(2.0))) == ["MESOP", "bullish", "investment"]
    assert one(spark, tags.news_tags(F.array(F.lit("Insider Tradings"), F.lit("x")))) == ["Insider Trading"]


def test_direction_and_titles(spark):
    assert one(spark, audit.direction_mismatch(F.lit(5), F.lit(4), F.lit("Buy"))) == "inconsistent_buy"
    assert one(spark, audit.direction_mismatch(F.lit(None).cast("int"), F.lit(4), F.lit("Buy"))) == "missing_before_or_after"
    assert one(spark, audit.direction_mismatch(F.lit(4), F.lit(5), F.lit("buy"))) is None
    got = one(spark, articles.title_and_body(F.lit("A"), F.lit("B"), F.lit("others"), F.lit(1500), F.lit(2000), F.lit(500), F.lit("")))
    assert got.title == "Change in A's position in B"
    assert got.body == "A executed a transaction for 1,500 shares of B. This decreases their holdings from 2,000 to 500 shares."
    assert one(spark, articles.without_on_date(F.lit("On December 18, 2025, X bought."))) == "X bought."


def test_scores(spark):
    assert fuzzy._ratio("abcd", "bcde") == 75.0
    assert fuzzy.token_set_score("a b c", "c b a d") == 100.0
    assert fuzzy.token_set_score("", "x") == 0.0
    assert one(spark, fuzzy.python_title(F.lit("o'neil"))) == "O'Neil"
    assert one(spark, fuzzy.unaccent_exact(F.lit("Ŝé"))) == "Se"


HEAD = "Jenis \nTransaksi\nRepurchase \nAgreement\nStatus \nKepemilikan\nHarga \n(Rp)\nTanggal \nTransaksi\nTujuan \nTransaksi\n"
FORM = (
    "Nama (sesuai SID)\n: DANA PENSIUN PT BANK DAERAH\nNama Perusahaan Tbk\n: YOII - ASURANSI DIGITAL  BERSAMA Tbk, PT\nJumlah Saham Sebelum Transaksi\n: 291.968.700,00 Unit\nHak Suara Sebelum Transaksi\n: 8,5222%\n"
    "Jumlah Saham Setelah Transaksi\n: 291.468.700,00 Unit\nHak Suara Setelah Transaksi\n: 8,5076%\n" + HEAD + "Penjualan\nTidak\nLangsung\n-\n-\n500.000,00\nSaham \nBiasa\n112,00\n09-Jan-\n2026\nHasil\nPenjualan\nlama\nsekali\ndan\nseterusnya\nsampai\nakhir\ntahun\nini\n"
    "Pelaksanaan\n(exercise)\nhak\nYa\n1.000,00\nSaham\n50,50\n10-Jan-2026\njangka\npanjang\n" + HEAD + "Pembelian\nTidak\n7,00\nSaham\n1,00\n11 Feb\n2026\nInvestasi\nSaya bertanggung jawab penuh\nPenjualan\nTidak\n9,00\nSaham\n9,00\n"
)


def test_form(spark):
    assert forms.read_form(FORM) == [
        {"type": "penjualan", "amount": 500000, "price": 112.0, "date": "09-Jan-2026", "purpose": "Hasil Penjualan lama sekali dan seterusnya sampai akhir tahun ini"},
        {"type": "pelaksanaan (exercise) hak", "amount": 1000, "price": 50.5, "date": "10-Jan-2026", "purpose": "jangka panjang"},
        {"type": "pembelian", "amount": 7, "price": 1.0, "date": "11-Feb-2026", "purpose": "Investasi"},
    ]
    assert forms.read_form(None) == [] and forms.read_form("Saham") == [] and forms.read_form(HEAD) == [] and forms.read_form(HEAD + "Pembelian\nTidak\n1,00\nSaham") == [{"type": "pembelian", "amount": 1, "price": None, "date": None, "purpose": None}]
    rows = forms.form_transactions(spark.createDataFrame([(1, FORM), (2, None)], "doc_id int, text string")).orderBy("pos").collect()
    assert [(r.type, r.date) for r in rows] == [("sell", "2026-01-09"), ("others", "2026-01-10"), ("buy", "2026-02-11")]
    assert one(spark, forms.form_holder(F.lit(FORM))) == "Dana Pensiun PT Bank Daerah"
    assert tuple(one(spark, forms.form_issuer(F.lit(FORM)))) == ("YOII.JK", "ASURANSI DIGITAL BERSAMA Tbk")
    assert tuple(one(spark, forms.form_holdings(F.lit(FORM)))) == (291968700, 291468700, 8.522, 8.508)
    assert tuple(one(spark, forms.form_issuer(F.lit("x")))) == (None, None) and one(spark, forms.form_holder(F.lit("x"))) is None
    assert forms.json_blocks('a={"k":"}{\\""} b={"x":{"y":1}} {bad}') == ['{"k":"}{\\""}', '{"x":{"y":1}}']
    assert one(spark, forms.emiten_code(F.lit("Nama Perusahaan Tbk\n: YOII - ASURANSI Tbk"))) == "YOII"
