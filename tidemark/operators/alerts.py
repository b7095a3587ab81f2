"""Alerts: defaults by code, buckets, counts, flattening for mail, outbox rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import symbol
from .lookup import last_wins

# Severity and stage-independent default message of each alert code.
CODES = {
    "low_title_similarity": ("fatal", "Announcement title and document name have low similarity."),
    "download_failed": ("fatal", "Failed to download the document after several attempts."),
    "unsupported_format": ("fatal", "Attachment is not a valid PDF or the format is unsupported."),
    "content_mismatch": ("fatal", "Attachment content does not match the expected announcement."),
    "non_idx_document": ("warning", "Non-IDX document detected, parsing is skipped."),
    "symbol_missing": ("fatal", "Could not resolve the issuer symbol from the document or mapping."),
    "table_not_found": ("fatal", "No compatible transaction table was found in the document."),
    "parse_exception": ("fatal", "Unexpected error while parsing the document."),
    "number_parse_error": ("fatal", "One or more numeric fields in the document could not be parsed."),
    "no_text_extracted": ("fatal", "No text could be extracted from the PDF at parser stage."),
    "symbol_name_mismatch": ("warning", "Resolved symbol does not match the company name found in the document."),
    "company_resolve_ambiguous": ("warning", "Issuer mapping is ambiguous; symbol resolution is below the confidence threshold."),
    "parser_warning": ("warning", "Parser extracted only partial data from the document; see reasons for details."),
    "price_deviation_vs_market": ("warning", "Transaction price deviates significantly from the market reference price."),
    "price_deviation_within_doc": ("soft", "Transaction price deviates significantly from the median transaction price in this document."),
    "possible_zero_missing": ("warning", "Transaction values may be off by a factor of 10 or 100 (possible missing zero)."),
    "stale_price": ("soft", "Reference market price is stale relative to the transaction date."),
    "missing_price": ("soft", "Market reference price is missing for the relevant date."),
    "percent_discrepancy": ("hard", "Reported shareholding percentages are inconsistent with the reported holdings."),
    "delta_pp_mismatch": ("hard", "Change in shareholding percentage is inconsistent with before/after values."),
    "mismatch_transaction_type": ("hard", "Parsed transaction type is inconsistent with the reported before/after values or document indicators."),
    "missing_required_field": ("hard", "One or more required fields are missing or null in the filing record."),
    "invalid_price_transaction": ("hard", "price_transaction block is empty or missing date/type/amount for buy/sell filings."),
    "mixed_transaction_type": ("hard", "Buy/Sell appears together with transfer/other; requires manual review."),
    "transfer_only_transaction": ("hard", "Transfer/other-only transaction; requires manual handling."),
    "transfer_uid_required": ("warning", None),
}
SEVERITIES = ["fatal", "hard", "warning", "soft"]

# What a reader of an alert should do next.
MANUAL = "Insert manually using the attached link, then re-run."
ACTIONS = {
    "price_deviation_vs_market": "Recalculate price vs reference range, adjust, and re-upload.",
    "price_deviation_within_doc": "Recalculate price vs reference range, adjust, and re-upload.",
    "possible_zero_missing": "Recalculate price vs reference range, adjust, and re-upload.",
    "percent_discrepancy": "Review holdings/percentages; correct and re-upload.",
    "delta_pp_mismatch": "Review holdings/percentages; correct and re-upload.",
    "mismatch_transaction_type": "Review holdings/percentages; correct and re-upload.",
    "symbol_missing": "Confirm correct symbol mapping, then re-run.",
    "company_resolve_ambiguous": "Confirm correct symbol mapping, then re-run.",
    "transfer_uid_required": "Pair both sides manually.",
    "missing_price": "Fetch latest price data and re-run validation.",
    "stale_price": "Fetch latest price data and re-run validation.",
}
REVIEW = "Review and re-run."


def codes(spark: SparkSession) -> DataFrame:
    """The dimension `code, severity, message`: as many rows as codes."""
    return spark.createDataFrame([(k, s, m) for k, (s, m) in CODES.items()], "code string, severity string, message string")


def with_defaults(alerts: DataFrame) -> DataFrame:
    """Message and severity by code where they are missing; an unknown code is its own message, and a warning."""
    dim = codes(alerts.sparkSession).toDF("code", "__severity", "__message")
    out = alerts.join(F.broadcast(dim), "code", "left")  # fixed size
    have = lambda c: F.col(c) if c in alerts.columns else F.lit(None).cast("string")
    out = out.withColumn("message", F.coalesce(F.nullif(have("message"), F.lit("")), "__message", "code")).withColumn("severity", F.coalesce(F.nullif(have("severity"), F.lit("")), "__severity", F.lit("warning")))
    return out.drop("__severity", "__message")


def action(code: Column, stage: Column, category: Column) -> Column:
    """Suggested action (L12): documents that failed before they were read are inserted by hand, else it goes by code."""
    by_code = F.try_element_at(F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv]), code)
    return F.when((category == "not_inserted") & stage.isin("downloader", "parser"), MANUAL).otherwise(F.coalesce(by_code, F.lit(REVIEW)))


def severity_counts(alerts: DataFrame, *by: str) -> DataFrame:
    """Counts by lower-cased severity and further columns."""
    return alerts.groupBy(*[F.lower(F.col(c)).alias(c) for c in by], F.lower("severity").alias("severity")).agg(F.count("*").alias("n"))


def top_codes(alerts: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent codes, ties by code."""
    return alerts.groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code").limit(k)


def attachment_link(attachments: Column, filename: Column, main_link: Column) -> Column:
    """The url of the attachment with a document's file name, else the announcement's own link."""
    name = F.lower(F.trim(filename))
    hit = F.get(F.filter(attachments, lambda a: (F.lower(F.trim(a["filename"])) == name) & (name != "")), F.lit(0))
    return F.coalesce(F.nullif(hit["url"], F.lit("")), main_link)


def symbol_mismatch(by_name: Column, code: Column) -> Column:
    """Whether a document's own code is another symbol than its company's name gives (J13); no code is no mismatch."""
    own = F.upper(F.trim(code))
    return F.coalesce(own.rlike(r"^[A-Z]{3,4}(\.JK)?$") & (symbol(own) != symbol(by_name)), F.lit(False))


def parser_alerts(found: DataFrame, announcements: DataFrame) -> DataFrame:
    """Alerts of the parser stage with the announcement's title, company and link.

    `found` has `filename, code` and, if known, `severity, message, reasons, needs_review`;
    `announcements` has `filename, title, company_name, date, main_link, attachments`,
    of which the last one by date counts for a file. A fatal alert means that the
    document is not inserted, any other that it is, for review.
    """
    doc = last_wins(announcements.withColumn("__file", F.lower(F.trim("filename"))).select("__file", "title", "company_name", F.col("date").alias("published_at"), "main_link", "attachments"), ["__file"], ["published_at", "main_link"])
    out = with_defaults(found.withColumn("__file", F.lower(F.trim("filename")))).join(doc, "__file", "left")
    out = out.withColumn("url", attachment_link(F.col("attachments"), F.col("filename"), F.col("main_link")))
    review = F.coalesce(F.col("needs_review"), F.lit(True)) if "needs_review" in found.columns else F.lit(True)
    fatal = F.lower("severity") == "fatal"
    return out.drop("__file", "attachments", "main_link").withColumns({"stage": F.lit("parser"), "category": F.when(fatal, "not_inserted").otherwise("inserted"), "needs_review": fatal | review})


def actionable(needs_review: Column, reasons: Column) -> Column:
    return F.coalesce(needs_review, F.lit(False)) | (F.coalesce(F.size(reasons), F.lit(0)) > 0)


def gate_reason(needs_review: Column, codes: Column, flags: dict[str, Column], gate: list[str]) -> Column:
    """Why a row is held back: its review flag, then the first gated code, then the first flag that is set; else null."""
    first = F.get(F.filter(codes, lambda c: c.isin(*gate)), F.lit(0))
    return F.coalesce(F.when(needs_review, "needs_review"), first, *[F.when(v, k) for k, v in flags.items()])


def _first_of(scopes) -> Column:
    def one(scope: str) -> Column:
        return F.get(F.filter("reasons", lambda r: r["scope"] == scope), F.lit(0))

    return F.coalesce(*[one(s) for s in scopes], F.get("reasons", F.lit(0)))


def flatten(alerts: DataFrame, scopes=("row", "tx")) -> DataFrame:
    """Mail fields with alias precedence; the reason of the preferred scope first."""
    chosen = _first_of(scopes)
    return alerts.select("*", chosen["code"].alias("reason_code"), chosen["message"].alias("reason_message"), F.concat_ws(", ", F.transform("reasons", lambda r: r["code"])).alias("reason_codes"))


def section(alerts: DataFrame, order: list, limit: int = 50) -> tuple[DataFrame, DataFrame]:
    """The first rows of a mail section and how many more there are."""
    return alerts.orderBy(*order).limit(limit), alerts.agg(F.greatest(F.count("*") - limit, F.lit(0)).alias("more"))


def outbox(rows: DataFrame, window: str) -> DataFrame:
    """One JSON payload a filing for whoever sends messages."""
    lo, hi = (window.split(" to ", 1) + [window])[:2]
    return rows.select(F.to_json(F.struct("*", F.lit(lo).alias("window_start"), F.lit(hi).alias("window_end"))).alias("payload"))
