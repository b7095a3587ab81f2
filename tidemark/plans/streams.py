"""Event-time queries, run on batches; the same functions take streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers
from ..streaming import microbatch
from .tables import read

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("""SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS start, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return microbatch.windows(read(spark, sf_dir, "events"), "ts", ["event_type"], "value", "6 hours").withColumn("total", F.round("total", 4))


@query("""WITH a AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM a)
 SELECT min(ts) AS start, max(ts) + INTERVAL 12 HOUR AS "end", user_id, count(*) AS n FROM b GROUP BY user_id, s""")
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return microbatch.sessions(read(spark, sf_dir, "events"), "ts", "user_id", "12 hours")


@query("""SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type""")
def microbatch_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the look-back operator keeps of a batch: the earliest event of each key."""
    return microbatch.deduplicated(read(spark, sf_dir, "events"), "ts", ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_totalprice BETWEEN 1000 AND 100000 AND lower(o_orderpriority) LIKE '%high%'""")
def pushed_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.table(spark, f"{sf_dir}/orders.parquet", bounds={"o_totalprice": (1000.0, 100000.0)}, isin={"o_orderstatus": ["F", "P"]}, like={"o_orderpriority": "%HIGH%"}, columns=["o_orderkey", "o_totalprice"])


@query("""SELECT CAST(unnest(generate_series(DATE '2024-02-27', DATE '2024-03-02', INTERVAL 1 DAY)) AS DATE) AS day""")
def day_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.days(spark, "2024-02-27", "2024-03-02")
