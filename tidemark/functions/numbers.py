"""Number expressions: tolerant parsing, exact decimal floors, ratios. ANSI-safe: every parse is a try."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(x: Column) -> Column:
    """Without commas and spaces around it; null if it isn't a number."""
    return F.replace(F.trim(x.cast("string")), F.lit(","), F.lit("")).try_cast("double")


def to_long(x: Column) -> Column:
    """Truncated toward zero; null if it isn't a number."""
    return to_double(x).try_cast("long")


def _kept(x: Column) -> Column:
    return F.regexp_replace(x.cast("string"), r"[^0-9,.\-]", "")


def _last(x: Column, sep: str) -> Column:
    """Place of the last `sep`, from 1; 0 if there is none."""
    return F.when(F.instr(x, sep) > 0, F.length(x) - F.instr(F.reverse(x), sep) + 1).otherwise(0)


def _both(t: Column) -> Column:
    """With commas and dots, the one that comes last is the decimal mark."""
    return F.when(_last(t, ",") > _last(t, "."), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(t, F.lit(","), F.lit("")))


def locale_number(x: Column) -> Column:
    """Number in either locale: three digits behind a single mark are thousands, several marks too; 0 if there is none."""
    t = _kept(F.coalesce(x.cast("string"), F.lit("")))
    commas, dots = F.contains(t, F.lit(",")), F.contains(t, F.lit("."))
    bare = lambda m: F.replace(t, F.lit(m), F.lit(""))
    thousands = lambda m, head: t.rlike(rf"^{head}\{m}[0-9]{{3}}$")
    many = lambda m: (F.length(t) - F.length(bare(m))) > 1
    out = (
        F.when(commas & dots, _both(t))
        .when(commas, F.when(many(",") | thousands(",", "[^,]*"), bare(",")).otherwise(F.replace(t, F.lit(","), F.lit("."))))
        .when(dots, F.when(many(".") | thousands(".", "-*[0-9][0-9-]*"), bare(".")).otherwise(t))
        .otherwise(t)
    )
    return F.coalesce(out.try_cast("double"), F.lit(0.0))


def locale_percent(x: Column) -> Column:
    """Percent in either locale, floored to five decimals; a single mark is always the decimal one; 0 if there is none."""
    t = _kept(F.coalesce(x.cast("string"), F.lit("")))
    commas, dots = F.contains(t, F.lit(",")), F.contains(t, F.lit("."))
    several = F.concat(F.replace(F.substring(t, F.lit(1), _last(t, ".") - 1), F.lit("."), F.lit("")), F.substring(t, _last(t, "."), F.length(t)))
    out = F.when(commas & dots, _both(t)).when(commas, F.replace(t, F.lit(","), F.lit("."))).when(dots, several).otherwise(t)
    return F.coalesce(floor_places(out, 5), F.lit(0.0))


def floor_places(x: Column, places: int = 3) -> Column:
    """Toward minus infinity, exact on the decimal digits of x as text; null if it isn't a number."""
    return F.floor(x.cast("string").try_cast("decimal(38,18)"), F.lit(places)).cast("double")


def dotted_number(x: Column) -> Column:
    """'.' between thousands and ',' before decimals, as a whole number."""
    return F.translate(F.regexp_replace(x, r"[^0-9.,\-]", ""), ",.", ".").try_cast("double").try_cast("long")


def grouped_int(x: Column) -> Column:
    """Whole number whose thousands may be grouped by dots, or by commas."""
    t = F.trim(x)
    return F.when(t.rlike(r"^-?[0-9]+(\.[0-9]{3})+$"), F.replace(t, F.lit("."), F.lit("")).try_cast("long")).when(t.rlike(r"^-?[0-9]+(,[0-9]{3})+$"), F.replace(t, F.lit(","), F.lit("")).try_cast("long")).otherwise(to_long(t))


def dash_is_zero(x: Column) -> Column:
    """'-', '–', '—' and '' as '0' (N8)."""
    return F.when(F.trim(x).isin("-", "–", "—", ""), "0").otherwise(x)


def key_number(x: Column) -> Column:
    """One spelling for each number, for comparing keys."""
    return x.cast("string").try_cast("decimal(38,10)")


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def missing_zero(price: Column, ref: Column, x10=(8.0, 15.0), x100=(80.0, 150.0)) -> Column:
    """x10_candidate or x100_candidate if the price is that many times the reference, else null."""
    r = F.abs(ratio(price, ref))
    return F.when(r.between(*x10), "x10_candidate").when(r.between(*x100), "x100_candidate")


def price_band(ref: Column, share: float = 0.15) -> Column:
    """struct<low, high> around a reference, low at least 0."""
    cents = lambda x: F.round(x.cast("decimal(30,6)"), 2).cast("double")
    return F.when(ref.isNotNull(), F.struct(F.greatest(F.lit(0.0), cents(ref * (1 - share))).alias("low"), cents(ref * (1 + share)).alias("high")))


def close_percent(a: Column, b: Column, tolerance: float = 1e-5) -> Column:
    """Whether two percents differ by no more than the tolerance, compared as decimals."""
    return F.coalesce(F.abs(key_number(a) - key_number(b)) <= F.lit(tolerance).cast("decimal(18,10)"), F.lit(False))
