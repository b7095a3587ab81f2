"""String expressions: names, slugs, file names, urls, narrative numbers. All are Column -> Column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and what they lose their marks to.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"

# Corporate words that a company key leaves out.
CORPORATE_WORDS = ["PT", "P.T", "PERSEROAN", "TERBATAS", "TBK", "TBK.", "TBK,", "TBK)", "(TBK", "PERSERO", "(PERSERO)"]

# Words that mark a holder as an organisation.
ORGANISATION_WORDS = [
    "PT", "TBK", "PTE", "LTD", "LIMITED", "INC", "CORP", "CORPORATION", "NV", "BV", "B.V.", "GMBH", "LLC", "LP", "LLP", "PLC",
    "SDN BHD", "BHD", "BERHAD", "BANK", "SECURITIES", "SEKURITAS", "ASSET MANAGEMENT", "MANAJER INVESTASI", "INVESTMENT", "FUND",
    "YAYASAN", "FOUNDATION", "KOPERASI", "UNIVERSITAS", "PERSERO",
]

# Spellings of the two holder types, and of none.
INSIDER_KEYS = [
    "insider", "insiders", "inside", "mgmt", "management", "key management", "key managerial", "kmp", "director", "directors",
    "board of directors", "bod", "commissioner", "commissioners", "board of commissioners", "boc", "officer", "officers", "key officer",
    "employee", "employees", "staff", "executive", "executives", "management and employees", "management & employees",
]
INSTITUTION_KEYS = [
    "institution", "institutional", "company", "corporate", "corp", "organization", "foundation", "yayasan", "bank", "fund",
    "mutual fund", "securities company", "asset manager", "pension fund", "insurance",
]
NULL_KEYS = ["", "-", "—", "n/a", "na", "none", "null", "unknown", "undefined"]


def blank_to_null(x: Column) -> Column:
    """Trimmed, null if nothing is left."""
    return F.nullif(F.trim(x), F.lit(""))


def first_filled(*xs: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(x) != "", x) for x in xs])


def truthy_number(*xs: Column) -> Column:
    """The first value that is neither null nor zero, as `a or b` picks it; else null."""
    return F.coalesce(*[F.when(x != 0, x) for x in xs])


def strip_diacritics(x: Column) -> Column:
    """Latin letters without their marks; what isn't ASCII then goes (C1). Letters outside the table need `unaccent_exact`."""
    return F.regexp_replace(F.translate(x, ACCENTED, PLAIN), r"[^\x00-\x7F]", "")


def kebab(x: Column) -> Column:
    """Words in lower case joined by '-', null if there is none."""
    return F.nullif(F.lower(F.regexp_replace(F.regexp_replace(strip_diacritics(x), "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")), F.lit(""))


def slug(x: Column) -> Column:
    return F.nullif(F.lower(F.regexp_replace(F.regexp_replace(x, "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")), F.lit(""))


def hyphenize(x: Column) -> Column:
    """Spaces, underscores and signs become single hyphens; case stays."""
    y = F.regexp_replace(F.trim(x), r"[_\s]+", "-")
    return F.regexp_replace(F.regexp_replace(y, "[^0-9A-Za-z-]+", "-"), "-{2,}", "-")


def company_key(x: Column) -> Column:
    """Upper-case words without corporate ones; '&' is AND."""
    up = F.replace(F.upper(strip_diacritics(F.coalesce(x, F.lit("")))), F.lit("&"), F.lit(" AND "))
    return F.array_join(F.filter(F.split(up, "[^A-Z0-9]+"), lambda t: (t != "") & ~t.isin(CORPORATE_WORDS)), " ")


def pretty_company(x: Column) -> Column:
    """Words in title case, hyphen parts too; PT upper-case, Tbk as such (C4)."""
    return F.array_join(
        F.transform(
            F.filter(F.split(F.trim(x), r"\s+"), lambda t: t != ""),
            lambda t: F.when(F.regexp_replace(F.upper(t), "[.,()]", "") == "PT", "PT").when(F.regexp_replace(F.upper(t), "[.,()]", "") == "TBK", "Tbk").otherwise(F.array_join(F.transform(F.split(F.lower(t), "-"), lambda p: F.initcap(p)), "-")),
        ),
        " ",
    )


def holder_name(x: Column) -> Column:
    """Printable, single spaces, capitalised words; corporate marks upper-case."""
    special = ["PT", "TBK", "LTD", "LIMITED"]
    words = F.filter(F.split(F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"\n", " "), r"\p{C}", "")), r"\s+"), lambda t: t != "")
    bare = lambda t: F.regexp_replace(F.upper(t), "^[.,]+|[.,]+$", "")
    return F.array_join(F.transform(words, lambda t: F.when(bare(t).isin(special), bare(t)).otherwise(F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 20))))), " ")


def holder_type(x: Column) -> Column:
    """institution if an organisation word or 'pt'/'tbk' occurs anywhere in it, else insider."""
    up = F.upper(F.trim(F.regexp_replace(x, r"\s+", " ")))
    some = F.lit(False)
    for w in ORGANISATION_WORDS:
        some = some | F.contains(up, F.lit(w))
    some = some | up.rlike(r"\b(CV|UD)\b")
    return F.when(F.coalesce(x, F.lit("")) == "", "insider").when(some, "institution").otherwise("insider")


def holder_is_valid(x: Column) -> Column:
    """At least 3 characters, at least 40 % of them letters."""
    t = F.trim(F.coalesce(x, F.lit("")))
    letters = F.length(F.regexp_replace(t, r"\P{L}", ""))
    return (F.length(t) >= 3) & (letters / F.greatest(F.length(t), F.lit(1)) >= 0.40)


def clean_text(x: Column) -> Column:
    """Zero-width marks go, white space is one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), "[​﻿]", ""), r"\s+", " "))


def text_key(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(clean_text(x)), r"[^\w\s\-&/]+", ""), r"\s+", " "))


def normal_holder_type(x: Column, strict: bool = False) -> Column:
    """Dictionary form of a holder type; an unknown one stays, or is null if strict."""
    k = text_key(x)
    return F.when(k.isin(NULL_KEYS), F.lit(None)).when(k.isin(INSIDER_KEYS), "insider").when(k.isin(INSTITUTION_KEYS), "institution").otherwise(F.lit(None) if strict else x)


def symbol(x: Column) -> Column:
    """Upper-case with `.JK`; null if blank."""
    up = F.upper(F.trim(x))
    return F.when(F.coalesce(up, F.lit("")) == "", None).when(up.endswith(".JK"), up).otherwise(F.concat(up, F.lit(".JK")))


def symbol_base(x: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(x)), r"\.JK$", "")


def basename(x: Column) -> Column:
    return F.nullif(F.element_at(F.split(F.regexp_replace(x, "/+$", ""), "/"), -1), F.lit(""))


def stem(x: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(basename(x), r"(?<=.)\.[^.]*$", "")


def safe_filename(url: Column, default: str = "file.pdf") -> Column:
    """Last path part in lower case with odd characters as '-'; only the last extension counts as one (C11)."""
    last = F.element_at(F.split(F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"(?s)[?#].*$", ""), "/+$", ""), "/"), -1)
    last = F.when(last.isin("", ".", ".."), default).otherwise(last)
    ext = F.regexp_replace(F.regexp_extract(last, r"\.([^.]*)$", 1), "[^A-Za-z0-9._-]+", "")
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(last, r"\.[^.]*$", ""), "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.lower(F.concat(F.when(name == "", "file").otherwise(name), F.when(ext == "", "").otherwise(F.concat(F.lit("."), ext))))


def is_url(x: Column) -> Column:
    return F.coalesce(x, F.lit("")).rlike(r"(?i)^https?://[^\s/]+")


def short_url(x: Column, keep: int = 40) -> Column:
    """Without scheme and query, cut to `keep` characters with an ellipsis."""
    y = F.regexp_replace(F.regexp_replace(x, r"(?i)^https?://", ""), r"[?#].*$", "")
    return F.when(F.length(y) > keep, F.concat(F.substring(y, 1, keep - 1), F.lit("…"))).otherwise(y)


def ticker(title: Column, company: Column) -> Column:
    """The company's first five characters, else four capitals in brackets of the title."""
    return F.coalesce(F.nullif(F.substring(F.trim(company), 1, 5), F.lit("")), F.nullif(F.regexp_extract(title, r"\[([A-Z]{4})\]", 1), F.lit("")))


def escape_html(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):  # fixed values, '&' first
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


UNITS = {"T": 1e12, "B": 1e9, "M": 1e6, "K": 1e3}


def abbreviated(x: Column, largest: str = "T") -> Column:
    """T, B, M or K, none above `largest`, with one decimal, '.0' left out; a dash for null."""

    def part(unit: float, mark: str) -> Column:
        return F.concat(F.regexp_replace(F.format_string("%.1f", x / F.lit(unit)), r"\.0$", ""), F.lit(mark))

    short = F.when(x.isNull(), "-")
    for mark, unit in UNITS.items():
        if unit <= UNITS[largest]:
            short = short.when(F.abs(x) >= unit, part(unit, mark))
    return short.otherwise(F.regexp_replace(F.format_string("%.1f", x.cast("double")), r"\.0$", ""))


def abbreviated_idr(x: Column) -> Column:
    """The short form of an amount behind 'IDR'; a dash without one."""
    return F.concat(F.lit("IDR "), abbreviated(x))


def percent_text(x: Column) -> Column:
    """Two decimals; a dash for null."""
    return F.when(x.isNull(), "-").otherwise(F.format_string("%.2f", x.cast("double")))


def title_words(x: Column, keep: int = 3) -> Column:
    """Words capitalised, upper-case ones of up to `keep` letters left as they are; empty for null."""
    words = F.filter(F.split(F.trim(F.coalesce(x, F.lit(""))), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.when((F.length(w) <= keep) & w.rlike(r"^\p{Lu}+$"), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w)))))), " ")


def dotted(x: Column) -> Column:
    """Whole number with '.' between thousands (C17)."""
    return F.translate(F.format_string("%,d", x.cast("long")), ",", ".")


def masked(x: Column, keep: int = 4) -> Column:
    """All but the last characters as '*' (C19)."""
    return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(x) - keep, F.lit(0))), F.right(x, F.lit(keep)))


def lowered(x: Column) -> Column:
    """Lower case, empty for null."""
    return F.lower(F.coalesce(x, F.lit("")))


def some_of(low: Column, words: list[str]) -> Column:
    """Whether any of the strings occurs in a text, in one search."""
    return low.rlike("|".join(re.escape(w) for w in words))


def any_word(x: Column, words: list[str]) -> Column:
    """Whether any of the strings occurs in the lower-cased text."""
    return some_of(lowered(x), words)


def truth(x: Column) -> Column:
    """Boolean of the usual spellings, else null."""
    low = F.lower(F.trim(x))
    return F.when(low.isin("1", "true", "yes", "y", "on"), True).when(low.isin("0", "false", "no", "n", "off"), False)
