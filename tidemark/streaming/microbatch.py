"""Micro-batches over files: a look-back window, duplicates dropped, a sink that stays idempotent.

State is bounded by the watermark, which is the look-back; what is older than that
is caught by an anti-join against the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import first_wins

LOOK_BACK = "120 minutes"


def stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _timed(rows: DataFrame, time: str) -> DataFrame:
    """Watermarks need an instant; a wall-clock time is taken in the session's zone."""
    return rows.withColumn(time, F.col(time).cast("timestamp"))


def deduplicated(rows: DataFrame, time: str, keys: list[str], look_back: str = LOOK_BACK) -> DataFrame:
    """One row a key within the look-back on a stream; on a batch, which has no watermark, the earliest row of each key."""
    if not rows.isStreaming:
        rest = [c for c in rows.columns if c not in (time, *keys)]
        return first_wins(_timed(rows, time), keys, [time, *rest]).select(*rows.columns)
    return _timed(rows, time).withWatermark(time, look_back).dropDuplicatesWithinWatermark(keys)


def write_new(rows: DataFrame, keys: list[str], sink: str, checkpoint: str, time: str | None = None, look_back: str = LOOK_BACK) -> StreamingQuery:
    """Appends what the sink hasn't; a batch that is run again appends nothing. The checkpoint holds the high-water mark.

    Of equal keys in a batch the first row by `time`, then by its other columns,
    stays. With `time` only sink rows from the look-back before the batch's first
    one on are read (a pushed predicate); without it the whole sink is. Each row
    gets the number of its batch and the time of its first attempt.
    """

    def put(batch: DataFrame, number: int) -> None:
        from ..sources.readers import exists

        spark = batch.sparkSession
        order = [c for c in ([time] if time else []) + batch.columns if c not in keys]
        fresh = first_wins(batch, keys, list(dict.fromkeys(order)) or keys).select(*batch.columns)
        if exists(spark, sink):
            stored = spark.read.parquet(sink)
            if time:
                first = batch.agg(F.min(F.col(time).cast("timestamp")) - F.expr(f"INTERVAL {look_back}")).first()[0]
                stored = stored.where(F.col(time) >= F.lit(first)) if first is not None else stored
            fresh = fresh.join(stored.select(*keys).distinct(), keys, "left_anti")
        fresh.withColumns({"batch": F.lit(number), "batch_time": F.current_timestamp()}).write.mode("append").parquet(sink)

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windows(rows: DataFrame, time: str, keys: list[str], value: str, length: str = "1 hour", slide: str | None = None, look_back: str = LOOK_BACK) -> DataFrame:
    """Counts and sums by event-time window (an extension); works on batches and streams."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return _timed(rows, time).withWatermark(time, look_back).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(rows: DataFrame, time: str, key: str, gap: str = "30 minutes", look_back: str = LOOK_BACK) -> DataFrame:
    """Sessions of a key by the gap between its events (an extension)."""
    w = F.session_window(time, gap)
    return _timed(rows, time).withWatermark(time, look_back).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")
