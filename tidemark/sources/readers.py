"""Readers: tolerant JSON, JSON lines, CSV, documents, stored tables with pushed predicates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import rows_of


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a JSON array; a missing file has none, a broken one is dropped."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = False) -> DataFrame:
    """One object a line; blank lines and, unless strict, bad ones are left out."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def containers(spark: SparkSession, paths: list[str] | str, schema: str) -> DataFrame:
    """Rows under any known container key, or of a bare list, of whole JSON files (S9, X33, X34, X39); `file` tells which."""
    files = spark.read.option("wholetext", True).text(paths).select(F.input_file_name().alias("file"), "value")
    each = files.select("file", F.explode(rows_of(F.col("value"))).alias("row"))
    return each.select("file", F.from_json(F.to_json("row"), schema).alias("r")).select("file", "r.*")


def csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def table(spark: SparkSession, path: str, eq: dict | None = None, bounds: dict[str, tuple] | None = None, isin: dict[str, list] | None = None, like: dict[str, str] | None = None, order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """A stored table with the predicates of a REST query, all of which reach the scan."""
    df = spark.read.parquet(path)
    for c, v in (eq or {}).items():
        df = df.where(F.col(c) == F.lit(v))
    for c, (lo, hi) in (bounds or {}).items():
        df = df.where((F.lit(lo is None) | (F.col(c) >= F.lit(lo))) & (F.lit(hi is None) | (F.col(c) <= F.lit(hi)))) if lo is None or hi is None else df.where(F.col(c).between(F.lit(lo), F.lit(hi)))
    for c, vs in (isin or {}).items():
        df = df.where(F.col(c).isin(vs))
    for c, v in (like or {}).items():
        df = df.where(F.lower(c).like(v.lower()))
    df = df.select(*columns) if columns else df
    return df.orderBy(*order) if order else df


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row a day, both ends included (S3)."""
    return spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 1 DAY)) AS day")


def documents(spark: SparkSession, path: str, decode: Callable[[bytes], str | None], pattern: str = "*.{pdf,PDF}") -> DataFrame:
    """`path, text, error` of binary files (S12, S15): the decoder is given, an error stays with its file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for p, c in zip(f["path"], f["content"], strict=True):
                try:
                    out.append((p, (decode(bytes(c)) or "").strip() or None, None))
                except Exception as e:  # noqa: BLE001  one file's failure is a row
                    out.append((p, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "text", "error"])

    return files.mapInPandas(run, "path string, text string, error string")


def best_table(tables: F.Column) -> F.Column:
    """Of several extractions (arrays of rows) the first with two rows or more, else the largest."""
    return F.coalesce(F.get(F.filter(tables, lambda t: F.size(t) >= 2), F.lit(0)), F.get(F.array_sort(tables, lambda a, b: F.size(b) - F.size(a)), F.lit(0)))


def fetch(rows: DataFrame, url: str, get: Callable[[str, bool], bytes], attempts: int = 3) -> DataFrame:
    """Rows with `content, error` of a given getter (S16, S18, X44): the first attempt plain, the others seeded."""
    schema = T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            content, errors = [], []
            for u in f[url]:
                got, err = None, None
                for k in range(attempts):
                    try:
                        got, err = get(u, k > 0), None
                        break
                    except Exception as e:  # noqa: BLE001  kept as the row's error
                        err = str(e)
                content.append(got)
                errors.append(err)
            yield f.assign(content=content, error=errors)

    return rows.mapInPandas(run, schema)
