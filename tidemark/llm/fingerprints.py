"""Operator 7: document fingerprints, bottom-k sketches of word-shingle hashes.

A fingerprint holds the `K` smallest distinct 64-bit hashes of a text's five-word
shingles (fewer words: the whole sequence is one shingle). Sketches of parts
merge by keeping the K smallest of both; two of them estimate resemblance and
containment, one estimates the number of distinct shingles. With up to K
shingles all of these are exact.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Table
from .shingles import shingle_sets, slices, trim

K = 128
WORDS = 5
#: Rows that one range bucket of `with_next` is meant to hold.
BUCKET_ROWS = 20_000
#: Buckets that are put in order together.
BLOCK = 1024


def sketch(texts: list[str | None], k: int = K, words: int = WORDS) -> list[np.ndarray]:
    return [s[:k] for s in shingle_sets(texts, words)]  # sets come sorted


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; two empty sketches are alike."""
    low = merge(a, b, k)
    if not len(low):
        return 1.0
    return float(np.isin(low, a, assume_unique=True)[np.isin(low, b, assume_unique=True)].sum() / len(low))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) / ((float(a[-1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; an empty a is contained."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return float(min(1.0, both / distinct(a, k)))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `fingerprint string`, `n_distinct double`; a null text is an empty one, whose fingerprint is ''."""
    src = docs.select(*keep, "text")
    kinds = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = sketch(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([to_text(s) for s in got], pa.string()), pa.array([distinct(s) for s in got], pa.float64())], [*keep, "fingerprint", "n_distinct"])

    return src.mapInArrow(run, f"{kinds}, fingerprint string, n_distinct double")


def merge_groups(docs: DataFrame, key: str) -> DataFrame:
    """`key, hashes array<bigint>`: the sketch of each key's texts together (signed, in unsigned order).

    Texts give at most K hashes each; equal ones meet in a partial distinct, and
    a partial top K runs before the shuffle, so a hot key stays bounded.
    """
    src = docs.select(F.col(key).alias("key"), "text")
    kind = src.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: dict = {}
        for batch in slices(batches):
            for k, s in zip(batch.column(0).to_pylist(), sketch(batch.column(1).to_pylist()), strict=True):
                part[k] = merge(part[k], s) if k in part else s
            if len(part) > 20_000:
                yield _rows(part)
                part = {}
        yield _rows(part)

    def _rows(part: dict) -> pa.RecordBatch:
        keys = [k for k, s in part.items() for _ in range(len(s))]
        # the top bit is flipped so that signed order is unsigned order
        hashes = np.concatenate([np.zeros(0, np.uint64), *part.values()]) ^ np.uint64(1 << 63)
        return pa.RecordBatch.from_arrays([pa.array(keys, field), pa.array(hashes.view(np.int64))], ["key", "h"])

    from pyspark.sql.pandas.types import to_arrow_type

    field = to_arrow_type(src.schema["key"].dataType)
    rows = src.mapInArrow(run, f"key {kind}, h bigint").distinct()
    rank = F.row_number().over(Window.partitionBy("key").orderBy("h"))
    low = rows.withColumn("__rank", rank).where(F.col("__rank") <= K)
    return low.groupBy("key").agg(F.sort_array(F.collect_list("h")).alias("hashes")).withColumnRenamed("key", key)


def _buckets(docs: DataFrame) -> tuple[F.Column, int]:
    """Bucket of doc_id, descending ids in ascending buckets, and how many; nulls have one of their own at the end.

    Quantiles cut the ids coarsely, and each coarse range is cut evenly.
    """
    spark = docs.sparkSession
    lo, hi, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    if lo is None:
        return F.lit(0), 1
    want = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS))
    coarse = min(want, 64)
    fine = -(-want // coarse)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / coarse for i in range(1, coarse)], 10_000)).first()[0] if coarse > 1 else []
    edges = sorted({lo, hi + 1, *cuts})
    arr, doc = F.lit(edges), F.col("doc_id")
    at = F.size(F.filter(arr, lambda e: e <= doc)) - 1
    low, high = F.get(arr, at), F.get(arr, at + 1)
    part = F.least(F.lit(fine - 1), F.floor((doc - low) * fine / (high - low)))
    total = (len(edges) - 1) * fine
    return F.coalesce(F.lit(total - 1) - (at * fine + part), F.lit(total)).cast("int"), total + 1


def _before(heads: DataFrame) -> Table:
    """`hb, head, prior` of `b, head`: each bucket that has rows and the one before it, the last before the first.

    Buckets are ordered within blocks of `BLOCK` buckets; to the driver comes one
    number a block.
    """
    heads = Table(heads.withColumn("block", F.floor(F.col("b") / BLOCK)), "heads")
    lasts = heads.df.groupBy("block").agg(F.max("b").alias("last")).orderBy("block").collect()
    rows = [(r.block, lasts[i - 1].last) for i, r in enumerate(lasts)]
    earlier = heads.spark.createDataFrame(rows, "block bigint, last int")
    within = F.lag("b").over(Window.partitionBy("block").orderBy("b"))
    return Table(heads.df.join(F.broadcast(earlier), "block").select(F.col("b").alias("hb"), "head", F.coalesce(within, "last").alias("prior")), "before")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows for `pair_up`: `__bucket, __tail, doc_id, text`, one partition a bucket, sorted by descending doc_id (nulls last; equal ids by descending text).

    The first row of each bucket is also sent, as a tail, to the bucket before it,
    the very first one to the last bucket. Texts are shuffled once as long as the
    buckets' first ids (one row for each `BUCKET_ROWS` documents) can be broadcast.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bucket, n = _buckets(docs)
    before = _before(docs.select("doc_id", bucket.alias("b")).groupBy("b").agg(F.max("doc_id").alias("head")))
    before = F.broadcast(before.df) if before.small() else before.df  # one row a bucket
    based = docs.withColumn("b", bucket).join(before, (F.col("b") == F.col("hb")) & F.col("doc_id").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("b").alias("b"), F.lit(False).alias("t"))
    to = F.when(F.col("prior").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("prior").alias("b"), F.lit(True).alias("t"))))
    sent = based.select("doc_id", "text", F.explode(to).alias("to")).select(F.col("to.b").alias("__bucket"), F.col("to.t").alias("__tail"), "doc_id", "text")
    return sent.repartitionById(n, F.col("__bucket")).sortWithinPartitions("__bucket", "__tail", F.col("doc_id").desc_nulls_last(), F.col("text").desc())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    h = len(text) // 2
    return text[: len(text) - h] + following[:h]


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """For every row: `doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`.

    The next row is the one with the next smaller doc_id; after the last comes
    the first. A null text is an empty one; null ids come after all others;
    rows with equal ids follow each other by descending text. A single row
    follows itself. Further columns are dropped.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # the last row, whose next one has not come
        at, done = None, False
        for batch in batches:
            rows, nexts = [], []
            cols = [c.to_pylist() for c in batch.columns]
            for b, tail, doc, text in zip(*cols, strict=True):
                if b != at:
                    at, done, waiting = b, False, None
                if done:
                    continue
                if waiting is not None:
                    rows.append(waiting)
                    nexts.append(text)
                waiting = (doc, text)
                done = tail
            if rows:
                yield from _out(rows, nexts)
            trim()

    def _out(rows: list[tuple], nexts: list[str]) -> Iterator[pa.RecordBatch]:
        step = 256
        for i in range(0, len(rows), step):
            part, after = rows[i : i + step], nexts[i : i + step]
            texts = [t for _, t in part]
            new = [edited(t, f) for t, f in zip(texts, after, strict=True)]
            own, changed = sketch(texts), sketch(new)
            follow = [*own[1:], *sketch(after[-1:])]  # rows follow each other
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d for d, _ in part], pa.int64()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
                    pa.array(map(to_text, own), pa.string()),
                    pa.array(map(to_text, changed), pa.string()),
                    pa.array(map(resemblance, own, changed), pa.float64()),
                    pa.array(map(resemblance, own, follow), pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(run, schema)
