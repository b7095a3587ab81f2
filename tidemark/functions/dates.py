"""Date expressions. The exchange's clock is UTC+7 the year round; `now` and `asof` are always parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "+07:00"

# Month names.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "januari": 1, "februari": 2, "maret": 3, "mei": 5, "juni": 6, "juli": 7, "agustus": 8, "oktober": 10, "desember": 12,
}
SHORT_MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "mei": 5, "may": 5, "jun": 6, "jul": 7, "agu": 8, "agt": 8, "aug": 8, "sep": 9, "okt": 10, "oct": 10, "nov": 11, "des": 12, "dec": 12,
}


def _lookup(names: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key)


def parse_date(x: Column) -> Column:
    """YYYYMMDD, or ISO with or without a time; else null."""
    t = F.trim(x)
    return F.when(t.rlike(r"^\d{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd")).try_cast("timestamp_ntz")).otherwise(t.try_cast("timestamp_ntz"))


def iso_date(x: Column) -> Column:
    return F.date_format(parse_date(x), "yyyy-MM-dd")


def has_offset(x: Column) -> Column:
    return x.rlike(r"(Z|[+-]\d\d:?\d\d)$")


def publish_time(x: Column) -> Column:
    """Instant of a publish time; without an offset it is UTC+7."""
    t = F.trim(x)
    return F.when(has_offset(t), t.try_cast("timestamp")).otherwise(F.concat(F.replace(t, F.lit(" "), F.lit("T")), F.lit(ZONE)).try_cast("timestamp"))


def local_time(instant: Column) -> Column:
    """Wall clock of the exchange."""
    return F.from_utc_timestamp(F.to_utc_timestamp(instant, F.current_timezone()), ZONE)


def month_name_date(x: Column) -> Column:
    """ISO date of the first `d Month yyyy` in English or Indonesian, else null (T5)."""
    pattern = r"(?i)\b(\d{1,2})\s+(" + "|".join(MONTHS) + r")\s+(\d{4})\b"
    part = lambda i: F.regexp_extract(x, pattern, i)
    return F.when(part(1) != "", F.concat_ws("-", part(3), F.lpad(_lookup(MONTHS, F.lower(part(2))).cast("string"), 2, "0"), F.lpad(part(1), 2, "0")))


def short_month_date(x: Column) -> Column:
    """ISO date of `dd-Mon-yyyy`; an unknown month is 01."""
    pattern = r"(\d{1,2})[- ]([A-Za-z]+)[- ](\d{4})"
    part = lambda i: F.regexp_extract(x, pattern, i)
    month = F.coalesce(_lookup(SHORT_MONTHS, F.lower(F.substring(part(2), 1, 3))), F.lit(1))
    return F.when(part(1) != "", F.concat_ws("-", part(3), F.lpad(month.cast("string"), 2, "0"), F.lpad(part(1), 2, "0")))


def to_minute(x: Column) -> Column:
    return F.date_trunc("minute", x)


def time_candidates(x: Column) -> Column:
    """Spellings under which a timestamp may stand elsewhere: as is, wall clock, UTC, first 19 characters; each once."""
    instant = publish_time(x)
    return F.array_distinct(F.filter(F.array(F.trim(x), F.date_format(local_time(instant), "yyyy-MM-dd'T'HH:mm:ss"), F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.substring(F.trim(x), 1, 19)), lambda t: t.isNotNull() & (t != "")))


def with_z(x: Column) -> Column:
    """A 'Z' behind a timestamp without offset."""
    return F.when(has_offset(x), x).otherwise(F.concat(x, F.lit("Z")))


def long_date(x: Column) -> Column:
    return F.date_format(x, "MMMM dd, yyyy")


def day_distance(a: Column, b: Column) -> Column:
    """Absolute days between two dates."""
    return F.abs(F.datediff(a, b))


def age_hours(since: Column, now: Column) -> Column:
    return F.timestamp_diff("SECOND", since, now) / 3600


def day_window(day: str, start: str | None, end: str | None) -> tuple[str, str] | None:
    """Bounds of HH:MM to HH:MM (its last second) on a YYYYMMDD day, into the next day if the end is earlier; none if either is missing (T4)."""
    from datetime import datetime, timedelta

    if not start or not end:
        return None
    lo = datetime.strptime(f"{day} {start}", "%Y%m%d %H:%M")
    hi = datetime.strptime(f"{day} {end}", "%Y%m%d %H:%M") + timedelta(seconds=59)
    if hi < lo:
        hi += timedelta(days=1)
    return lo.isoformat(), hi.isoformat()


def month_range(month: str) -> tuple[str, str]:
    """First and last day of a YYYYMM month."""
    from calendar import monthrange

    y, m = int(month[:4]), int(month[4:6])
    return f"{y:04d}-{m:02d}-01", f"{y:04d}-{m:02d}-{monthrange(y, m)[1]:02d}"


def look_back(now, minutes: int = 120):
    """(now - minutes, now)."""
    from datetime import timedelta

    return now - timedelta(minutes=minutes), now
