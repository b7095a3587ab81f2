"""Facts from document text: label lookups, transaction lines, the new form's line blocks, embedded JSON."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import locale_number

# Words of the bilingual form.
FORM_TYPES = ("Penjualan", "Pembelian", "Lainnya", "Koreksi", "Pelaksanaan", "(exercise)")
FORM_MARKS = ("Tidak", "Ya", "Langsung")
FORM_ENDS = ("Pemberi", "Keterangan", "Jika", "Nama pemegang", "Informasi", "Saya bertanggung", "Hak Suara")
FORM_HEAD, FORM_HEAD_END = ("Jenis", "Transaksi"), ("Tujuan", "Transaksi")


def text_lines(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: F.trim(x))


def label_value(text: Column, label: str) -> Column:
    """Value of a label: behind it on its line (after two spaces or a colon), else the next line that isn't blank."""
    lines = text_lines(text)
    pattern = rf"(?i)^{label}\s*(?:\s{{2,}}|:)\s*(.+)$"
    same = F.get(F.filter(F.transform(lines, lambda x: F.regexp_extract(x, pattern, 1)), lambda v: v != ""), F.lit(0))
    at = F.array_position(F.transform(lines, lambda x: x.rlike(rf"(?i)^{label}\s*:?$")), True)
    following = F.filter(F.slice(lines, (at + 1).cast("int"), F.lit(3)), lambda x: x != "")
    return F.coalesce(same, F.when(at > 0, F.regexp_replace(F.get(following, F.lit(0)), r"^:\s*", "")))


def after_marker(text: Column, marker: str) -> Column:
    """The text behind the first line that has the marker, else the whole."""
    lines = F.split(text, "\n")
    at = F.array_position(F.transform(lines, lambda x: F.lower(x).contains(marker.lower())), True)
    return F.when(at > 0, F.array_join(F.slice(lines, (at + 1).cast("int"), F.size(lines)), "\n")).otherwise(text)


def transaction_lines(text: Column) -> Column:
    """array<struct<type,amount,price,date>> of `Type amount price date` lines."""
    pattern = r"(?i)^(buy|sell|transfer|others?)\s+([0-9][0-9.,]*)\s+([0-9][0-9.,]*)\s+(\d{1,2}[- ][A-Za-z]+[- ]\d{4}|\d{4}-\d{2}-\d{2})"
    part = lambda x, i: F.regexp_extract(x, pattern, i)
    hits = F.filter(text_lines(text), lambda x: x.rlike(pattern))
    return F.transform(hits, lambda x: F.struct(F.lower(part(x, 1)).alias("type"), locale_number(part(x, 2)).cast("long").alias("amount"), locale_number(part(x, 3)).alias("price"), part(x, 4).alias("date")))


def declared_type(text: Column, within: int = 7) -> Column:
    """buy or sell if it stands within some lines behind 'transaction type' (X8)."""
    lines = F.transform(text_lines(text), lambda x: F.lower(x))
    at = F.array_position(F.transform(lines, lambda x: x.contains("transaction type")), True)
    near = F.array_join(F.slice(lines, (at + 1).cast("int"), F.lit(within)), " ")
    return F.when(at > 0, F.when(near.rlike(r"\b(buy|purchase)\b"), "buy").when(near.rlike(r"\b(sell|sale)\b"), "sell"))


def title_and_reporter(text: Column) -> Column:
    """struct<title, reporter>: the line that names the report, and what stands behind the last colon of the registrar's line, else UNKNOWN."""
    lines = F.filter(text_lines(text), lambda x: x != "")
    line = lambda word: F.get(F.filter(lines, lambda x: F.upper(x).contains(word)), F.lit(0))
    bae = line("BAE")
    return F.struct(F.coalesce(line("LAPORAN KEPEMILIKAN EFEK"), F.lit("")).alias("title"), F.when(bae.contains(":"), F.trim(F.element_at(F.split(bae, ":"), -1))).otherwise("UNKNOWN").alias("reporter"))


def flattened(results: DataFrame, rows: str = "rows") -> DataFrame:
    """One row for each parsed row of a file; files without any go."""
    return results.select(*[c for c in results.columns if c != rows], F.explode(rows).alias("__r")).select(*[c for c in results.columns if c != rows], "__r.*")


def issuer_name(text: Column) -> Column:
    """The labelled issuer, else 'PT … Tbk' anywhere."""
    some = lambda p: F.nullif(F.trim(F.regexp_extract(text, p, 1)), F.lit(""))
    return F.coalesce(some(r"(?im)^(?:nama perusahaan tbk|nama emiten|issuer name)\s*:?\s*\n?\s*:?\s*(.+)$"), some(r"(PT\s+[A-Z][\w .&-]{2,60}?\s+Tbk)"))


def emiten_code(text: Column) -> Column:
    """Four capitals before ' - ' behind the company label."""
    return F.nullif(F.regexp_extract(text, r":\s*([A-Z]{4})\s+-\s+", 1), F.lit(""))


def pages_with(pages: Column, *words: str) -> Column:
    """Pages that have all of the words."""
    test = lambda p: F.lower(p).contains(words[0].lower())

    def every(p: Column) -> Column:
        out = test(p)
        for w in words[1:]:
            out = out & F.lower(p).contains(w.lower())
        return out

    return F.filter(pages, every)


def _number(s: str) -> float | None:
    s = s.strip().replace(".", "").replace(",", ".")
    try:
        return float(s)
    except ValueError:
        return None


def _pairs(lines: list[str], pair: tuple[str, str]) -> list[int]:
    return [i for i in range(len(lines) - 1) if (lines[i], lines[i + 1]) == pair]


def _tables(lines: list[str]) -> list[list[str]]:
    """The cells behind each header of the table; a footer ends the last one."""
    heads = _pairs(lines, FORM_HEAD)
    if not heads:
        return []
    ends = _pairs(lines, FORM_HEAD_END)
    stop = next((i for i in range(heads[0], len(lines)) if lines[i].startswith(FORM_ENDS)), len(lines))
    cut = []
    for head, after in zip(heads, [*heads[1:], stop], strict=True):
        end = next((e + 2 for e in ends if head <= e < after), None)
        if end is None:  # a header that was cut off: cells begin with a type word
            end = next((i for i in range(head, after) if lines[i] in FORM_TYPES), after)
        cut.append(lines[end : min(after, stop)])
    return cut


def _starts(cells: list[str]) -> list[tuple[int, int]]:
    """Where transactions begin and where their type ends: a type word counts only if Tidak, Ya or Langsung follows within nine cells."""
    out, i = [], 0
    while i < len(cells):
        if cells[i] in FORM_TYPES and any(x in FORM_MARKS for x in cells[i + 1 : i + 10]):
            kind_end = next((k for k in range(i + 1, len(cells)) if cells[k] in FORM_MARKS[:2]), len(cells))
            out.append((i, kind_end))
            i = kind_end
        i += 1
    return out


def _is_amount(cell: str) -> bool:
    return "," in cell and any(c.isdigit() for c in cell)


def _date(cells: list[str]) -> tuple[str | None, int]:
    """The first date, which may be broken over up to five cells, and the place behind it."""
    import re

    first = next((i for i, c in enumerate(cells) if re.match(r"\d{1,2}[\s-]", c)), None)
    if first is None:
        return None, 0
    for size in range(1, 6):
        parts = cells[first : first + size]
        if parts[-1:] and re.search(r"(^|[\s-])\d{4}$", parts[-1]):
            return re.sub(r"[\s-]+", "-", " ".join(parts)), first + size
    return re.sub(r"[\s-]+", "-", " ".join(cells[first : first + 5])), min(first + 5, len(cells))


def read_form(text: str | None) -> list[dict]:
    """Transactions of the new form, whose table cells come as lines.

    The amount is the number above a cell 'Saham', the price the next number, then
    comes the date; what is left up to the next transaction, header or footer is the
    purpose. A type may take several cells.
    """
    lines = [x for x in (y.strip() for y in (text or "").split("\n")) if x]
    out = []
    for cells in _tables(lines):
        starts = _starts(cells)
        for (at, kind_end), (end, _) in zip(starts, [*starts, (len(cells), 0)][1:], strict=True):
            block = cells[kind_end + 1 : end]
            share = next((k for k in range(1, len(block)) if block[k] == "Saham" and _is_amount(block[k - 1])), None)
            if share is None or (amount := _number(block[share - 1])) is None:
                continue
            rest = block[share + 1 :]
            price = next((k for k, c in enumerate(rest[:10]) if _is_amount(c)), 0)
            date, behind = _date(rest[price + 1 :])
            purpose = " ".join(rest[price + 1 + behind :])
            out.append({"type": " ".join(cells[at:kind_end]).lower(), "amount": int(amount), "price": _number(rest[price]) if rest else None, "date": date, "purpose": purpose or None})
    return out


def split_groups(txs: Column) -> Column:
    """struct<others, trades> of an array of transactions with a purpose (A20): each group's transactions without it, and its last one; null without any."""

    def group(test) -> Column:
        some = F.filter(txs, test)
        return F.when(F.size(some) > 0, F.struct(F.transform(some, lambda t: t.dropFields("purpose")).alias("price_transaction"), F.element_at(some, -1)["purpose"].alias("purpose")))

    return F.struct(group(lambda t: t["type"] == "others").alias("others"), group(lambda t: t["type"].isin("buy", "sell")).alias("trades"))


def form_holder(text: Column) -> Column:
    """The holder behind 'Nama (sesuai SID)', words capitalised, PT upper-case."""
    name = F.nullif(F.trim(F.regexp_extract(text, r"(?i)Nama \(sesuai SID\)\s*:\s*([^\n]+)", 1)), F.lit(""))
    return F.regexp_replace(F.initcap(name), r"\bPt\b", "PT")


def form_issuer(text: Column) -> Column:
    """struct<symbol, company_name> behind 'Nama Perusahaan Tbk' (R15)."""
    pattern = r"(?s)Nama Perusahaan Tbk\s*:\s*([A-Z]+)\s*-\s*(.+?)(?=Tbk|PT|Jumlah Saham)(.{0,20})"
    part = lambda i: F.regexp_extract(text, pattern, i)
    name = F.regexp_replace(F.regexp_replace(F.trim(part(2)), r"\s+", " "), r"[,\s]+$", "")
    full = F.when(part(3).contains("Tbk"), F.concat(name, F.lit(" Tbk"))).otherwise(name)
    return F.struct(F.when(part(1) != "", F.concat(part(1), F.lit(".JK"))).alias("symbol"), F.when(part(1) != "", full).alias("company_name"))


def form_holdings(text: Column) -> Column:
    """struct of shares before and after, and of voting rights in percent with three decimals."""
    some = lambda label, chars: F.nullif(F.regexp_extract(text, rf"(?i){label}\s*:\s*({chars}+)", 1), F.lit(""))
    count = lambda label: F.replace(F.replace(some(label, r"[\d.,]"), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double").try_cast("long")
    share = lambda label: F.round(F.replace(some(label, r"[\d,]"), F.lit(","), F.lit(".")).try_cast("double"), 3)
    return F.struct(
        count("Jumlah Saham Sebelum Transaksi").alias("holding_before"), count("Jumlah Saham Setelah Transaksi").alias("holding_after"),
        share("Hak Suara Sebelum Transaksi").alias("share_percentage_before"), share("Hak Suara Setelah Transaksi").alias("share_percentage_after"),
    )


def form_transactions(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, pos, type, amount, price, date, purpose` of every transaction in the new form's texts."""
    from ..functions.dates import short_month_date
    from .tags import form_type

    kind = docs.schema[id_].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [{id_: i, "pos": k, **r} for i, t in zip(f[id_], f[text], strict=True) for k, r in enumerate(read_form(t))]
            yield pd.DataFrame(rows, columns=[id_, "pos", "type", "amount", "price", "date", "purpose"])

    got = docs.select(id_, text).mapInPandas(run, f"{id_} {kind}, pos int, type string, amount bigint, price double, date string, purpose string")
    return got.withColumn("type", F.coalesce(form_type(F.col("type")), F.col("type"))).withColumn("date", short_month_date(F.col("date")))


def json_blocks(text: str | None, key: str | None = None) -> list[str]:
    """Outermost balanced objects that parse as JSON, with the key if one is asked for; text in quotes doesn't count."""
    import json

    out, depth, start, quoted, escaped = [], 0, 0, False, False
    for i, c in enumerate(text or ""):
        if depth and quoted:
            quoted, escaped = (quoted, False) if escaped else (c != '"', c == "\\")
            continue
        if c == '"' and depth:
            quoted = True
        elif c == "{":
            start = i if depth == 0 else start
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                try:
                    got = json.loads(text[start : i + 1])
                except ValueError:
                    continue
                if key is None or key in got:
                    out.append(text[start : i + 1])
    return out


def extract_json(rows: DataFrame, id_: str, text: str, key: str | None = None) -> DataFrame:
    """`id, pos, block` of every embedded JSON object."""
    kind = rows.schema[id_].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [(i, k, b) for i, t in zip(f[id_], f[text], strict=True) for k, b in enumerate(json_blocks(t, key))]
            yield pd.DataFrame(got, columns=[id_, "pos", "block"])

    return rows.select(id_, text).mapInPandas(run, f"{id_} {kind}, pos int, block string")
