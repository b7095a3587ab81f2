"""Sinks: files by Spark's committer, buckets of alerts, a row sink with results, manifests."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import allowed


def json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines without null fields; a job commits whole or not at all (K1, K2)."""
    rows.write.mode(mode).option("ignoreNullFields", True).json(path)


def csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("header", True).csv(path)


def alert_buckets(alerts: DataFrame, path: str, run: str) -> None:
    """One folder a category and run."""
    alerts.withColumn("run", F.lit(run)).write.mode("append").partitionBy("category", "run").json(path)


def read_bucket(spark: SparkSession, path: str, category: str) -> DataFrame:
    return spark.read.json(path).where(F.col("category") == category)


def upload(rows: DataFrame, send: Callable[[dict], None], columns: list[str] | None = None, stop_on_first_error: bool = False) -> DataFrame:
    """`ok, error, row` of each row sent by a given function (K3, X42): null fields are left out, a failure stays with its row.

    With `stop_on_first_error` a task sends nothing after its first failure; the rows
    that it leaves have the error 'not sent'.
    """
    out = allowed(rows, columns) if columns else allowed(rows)
    payload = out.select(F.to_json(F.struct("*")).alias("row"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json as j

        failed = False
        for f in frames:
            ok, err = [], []
            for r in f["row"]:
                if failed and stop_on_first_error:
                    ok.append(False)
                    err.append("not sent")
                    continue
                try:
                    send(j.loads(r))
                    ok.append(True)
                    err.append(None)
                except Exception as e:  # noqa: BLE001  collected as the row's result
                    failed = True
                    ok.append(False)
                    err.append(str(e))
            yield pd.DataFrame({"ok": ok, "error": err, "row": f["row"]})

    return payload.mapInPandas(run, "ok boolean, error string, row string")


def manifest(spark: SparkSession, path: str, include: str = "*", exclude: list[str] | None = None) -> DataFrame:
    """`path, size, modified, sha256` of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", include).option("recursiveFileLookup", True).load(path)
    for e in exclude or []:
        files = files.where(~F.col("path").like(e.replace("*", "%")))
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def manifest_totals(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def upload_alerts(sent: DataFrame, table: str) -> DataFrame:
    """Alerts of the rows of `upload` that weren't taken, with the error as reason."""
    return sent.where(~F.col("ok")).select(F.lit("upload_failed").alias("code"), F.lit("upload").alias("stage"), F.lit("not_inserted").alias("category"), F.concat(F.lit(f"{table}: "), F.coalesce("error", F.lit("unknown"))).alias("message"), F.lit(True).alias("needs_review"), "row")


def is_stale(rows: int, cached_rows: int, age_hours: float, most_hours: float = 12.0, checksum: str | None = None, cached_checksum: str | None = None) -> bool:
    """A cached dimension is rebuilt if its count or checksum differs or it is too old."""
    return rows != cached_rows or age_hours >= most_hours or checksum != cached_checksum
