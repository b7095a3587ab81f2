"""Classification rules: transaction types, text flags, tags, sentiment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.arrays import once
from ..functions.text import hyphenize, lowered, some_of

# Keyword banks.
BUY = ["beli", "pembelian", "buy", "akumulasi", "investasi", "acquisition", "penambahan", "increase", "buyback", "buy back", "investment", "peningkatan", "akuisisi"]
SELL = ["jual", "penjualan", "sell", "divestasi", "divestment", "pengurangan", "reduksi", "disposal"]
TRANSFER = ["transfer", "pemindahan", "konversi", "conversion", "neutral", "tanpa perubahan", "alih", "pengalihan"]
INHERIT = ["waris", "inheritance", "hibah", "grant", "bequest"]
MESOP = ["mesop", "msop", "esop", "program opsi saham", "employee stock option"]
FREE_FLOAT = ["free float", "free-float", "freefloat", "pemenuhan porsi publik"]
RESTRUCTURING = ["restrukturisasi", "restructuring", "reorganisasi", "penyelesaian penurunan modal"]
REPURCHASE = ["repo", "transaksi repurchase", "transaksi repo"]
PLACEMENT = ["penempatan saham revo", "penempatan"]
CORRECTION = ["perbaikan", "koreksi", "ralat", "errata", "amendment"]

# Tags that filings and records may carry.
FILING_TAGS = ["takeover", "investment", "divestment", "placement", "capital-restructuring", "free-float-compliance", "free-float-requirement", "mesop", "inheritance", "share-transfer", "repurchase-agreement"]
RECORD_TAGS = ["takeover", "mesop", "inheritance", "award", "share-transfer", "internal-strategy", "investment", "divestment", "capital-restructuring", "free_float_requirement", "repurchase-agreement"]
RECORD_TYPES = ["buy", "sell", "share-transfer", "others", "award", "inheritance", "mesop"]
REASON_TAGS = ["divestment", "investment", "free-float-requirement", "MESOP", "inheritance", "share-transfer"]

# Spellings of tags.
VARIANTS = {
    "mesop": "MESOP", "mesop-program": "MESOP", "free-float-requirement": "free-float-requirement", "freefloatrequirement": "free-float-requirement",
    "free-float": "free-float-requirement", "free-float-req": "free-float-requirement", "freefloat": "free-float-requirement", "freefloat-req": "free-float-requirement",
    "share-transfer": "share-transfer", "sharetransfer": "share-transfer", "investment": "investment", "invest": "investment", "divestment": "divestment", "divest": "divestment",
    "inheritance": "inheritance", "inheritence": "inheritance", "bullish": "bullish", "bull": "bullish", "bearish": "bearish", "bear": "bearish",
    "takeover": "takeover", "take-over": "takeover",
}
INSIDER_TAGS = ["insider-trading", "insider-tradings", "insider", "insider-trader", "insider-trade"]


def record_type(raw: Column, before: Column, after: Column) -> Column:
    """The type if it is a known one, else by the holdings, else others (L1)."""
    t = F.lower(F.trim(raw))
    return F.when(t.isin(RECORD_TYPES), t).when(after > before, "buy").when(after < before, "sell").otherwise("others")


def crosses_half(before: Column, after: Column) -> Column:
    """A holding passes 50 %: from below to 50 or more, or from 50 or more to below."""
    return F.coalesce(((before < 50) & (after >= 50)) | ((before >= 50) & (after < 50)), F.lit(False))


def crosses_half_strictly(before: Column, after: Column) -> Column:
    """As the back-fill has it: 50 itself is on neither side."""
    return F.coalesce(((before < 50) & (after > 50)) | ((before > 50) & (after < 50)), F.lit(False))


def document_type(text: Column, before: Column, after: Column) -> Column:
    """neutral for corrections; sell words before buy words, then transfers and inheritances, then the percents (L2)."""
    by_percent = F.when(after > before, "buy").when(after < before, "sell").otherwise("neutral")
    by_words = lambda low: F.when(some_of(low, CORRECTION), "neutral").when(some_of(low, SELL), "sell").when(some_of(low, BUY), "buy").when(some_of(low, TRANSFER + INHERIT), "transfer")
    return F.coalesce(once(lowered(text), by_words), by_percent)


def text_flags(text: Column) -> Column:
    """Five booleans of a text (L3)."""
    banks = {"mesop": MESOP, "free_float_requirement": FREE_FLOAT, "inheritance": INHERIT, "share_transfer_hint": TRANSFER, "capital_restructuring": RESTRUCTURING}
    return once(lowered(text), lambda low: F.struct(*[some_of(low, bank).alias(name) for name, bank in banks.items()]))


def _named(*pairs: tuple[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(cond, F.lit(tag)) for tag, cond in pairs]), lambda t: t.isNotNull())


def new_form_tags(purpose: Column, before: Column, after: Column, type_: Column) -> Column:
    """Sorted tags by purpose; the type stands in if there are none and settles a conflict (L4)."""
    banks = {"mesop": MESOP, "free_float_compliance": FREE_FLOAT, "inheritance": INHERIT, "share-transfer": TRANSFER, "capital-restructuring": RESTRUCTURING, "investment": BUY, "divestment": SELL, "repurchase-agreement": REPURCHASE, "placement": PLACEMENT}
    by_type = _named(("investment", type_ == "buy"), ("divestment", type_ == "sell"))

    def settled(some: Column) -> Column:
        both = F.array_contains(some, "investment") & F.array_contains(some, "divestment")
        return F.when(both & (type_ == "buy"), F.array_remove(some, "divestment")).when(both & (type_ == "sell"), F.array_remove(some, "investment")).otherwise(some)

    found = once(lowered(purpose), lambda low: _named(*[(t, some_of(low, b)) for t, b in banks.items()]))
    some = once(found, lambda f: F.when(F.size(f) > 0, f).otherwise(by_type))
    return F.array_sort(F.concat(once(some, settled), _named(("takeover", crosses_half(before, after)))))


def filing_tags(types: Column, before: Column, after: Column, flags: Column, compat: bool = False) -> Column:
    """Sorted tags of a filing's transaction types and text flags (L5). `compat` drops the two that the stored list never let through."""
    buy, sell = F.array_contains(types, "buy"), F.array_contains(types, "sell")
    tags = _named(
        ("investment", buy & ~sell), ("divestment", sell & ~buy), ("share-transfer", F.array_contains(types, "transfer") | flags["share_transfer_hint"]),
        ("inheritance", flags["inheritance"]), ("takeover", crosses_half(before, after)), ("free-float-requirement", flags["free_float_requirement"]), ("mesop", flags["mesop"]),
    )
    keep = [t for t in FILING_TAGS if not (compat and t in ("free-float-requirement", "mesop"))]
    return F.array_sort(F.filter(tags, lambda t: t.isin(keep)))


def record_tags(raw: Column, type_: Column) -> Column:
    """Known tags of the list, and the type if it is one; a transfer tag only with a type it suits."""
    low = F.lower(F.coalesce(type_, F.lit("")))
    kept = F.filter(F.transform(F.coalesce(raw, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t))), lambda t: t.isin(RECORD_TAGS) & ((t != "share-transfer") | low.isin("share-transfer", "others", "buy", "sell")))
    return F.array_sort(F.array_distinct(F.concat(kept, _named(*[(t, low == t) for t in RECORD_TAGS]))))


def canonical_tag(tag: Column) -> Column:
    """Canonical spelling, null for tags that are dropped."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in VARIANTS.items() for x in kv]), F.lower(hyphenize(tag)))


def backfilled_tags(raw: Column, before: Column, after: Column) -> Column:
    """Reason tags kept, bullish or bearish by the percents, takeover; MESOP first, the rest sorted."""
    kept = F.filter(F.transform(F.coalesce(raw, F.array().cast("array<string>")), canonical_tag), lambda t: t.isin(REASON_TAGS))
    every = F.array_distinct(F.concat(kept, _named(("bullish", after > before), ("bearish", after < before), ("takeover", crosses_half_strictly(before, after)))))
    return F.concat(F.filter(every, lambda t: t == "MESOP"), F.array_sort(F.filter(every, lambda t: t != "MESOP")))


def news_tags(raw: Column) -> Column:
    """Only 'Insider Trading' if any spelling of it occurs, else without buy and sell."""
    raw = F.coalesce(raw, F.array().cast("array<string>"))
    key = lambda t: F.lower(hyphenize(t))
    return F.when(F.exists(raw, lambda t: key(t).isin(INSIDER_TAGS)), F.array(F.lit("Insider Trading"))).otherwise(F.filter(raw, lambda t: ~key(t).isin("buy", "sell")))


def form_type(raw: Column) -> Column:
    """Type of the new form's wording (L10): corrections as they are, else others, sell, buy, others; null if unknown."""
    low = F.lower(raw)
    return F.when(low.contains("koreksi atas laporan"), low).when(low.contains("pelaksanaan"), "others").when(low.contains("penjualan"), "sell").when(low.contains("pembelian"), "buy").when(low.contains("lainnya"), "others")


def sentiment(type_: Column) -> Column:
    """positive for buys, negative for sells, neutral else."""
    low = F.lower(F.coalesce(type_, F.lit("")))
    return F.when(low.isin("buy", "award", "purchase"), "positive").when(low.isin("sell", "disposal"), "negative").otherwise("neutral")


def inferred_direction(before: Column, after: Column, pct_before: Column, pct_after: Column) -> Column:
    """By the holdings, then by the percents, else neutral."""
    return F.when(after > before, "buy").when(after < before, "sell").when(pct_after > pct_before, "buy").when(pct_after < pct_before, "sell").otherwise("neutral")
