"""Operator 4 (native): benchmark decontamination by size-partitioned MinHash containment.

DataFrame functions only. An item of n five-word shingles is found in a document
if the document has at least `threshold` of them. Items are partitioned by size,
class j holding 2^j to 2^(j+1)-1 shingles; an item is sketched by its smallest
hashes, as many as one more than its class can lose. So a document that contains
the item has at least one hash of its sketch: the search misses none. Documents
are streamed unsketched, as a sketch of a long text would lose a short item.
Candidates are verified by exact containment on the shingles' words. An item of
one to four words is one shingle of its own length, and documents give shingles of
such lengths only if there are such items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Table

WORDS = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _rolled(items: Column, make, size: int = WORDS) -> Column:
    at = F.when(F.size(items) >= size, F.sequence(F.lit(0), F.size(items) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, make)


def _shingles(ws: Column, sizes: tuple[int, ...], make) -> Column:
    """Distinct shingles of each size; `make` takes a shingle's words. `ws` must be a plain column: it is read once for each shingle."""

    def of(size: int) -> Column:
        return _rolled(ws, lambda i: make([F.get(ws, i + j) for j in range(size)]), size)

    return F.array_distinct(F.concat(*[of(k) for k in sizes]))


def shingle_hashes(ws: Column, sizes: tuple[int, ...] = (WORDS,)) -> Column:
    return _shingles(ws, sizes, lambda parts: F.xxhash64(*parts))


def shingle_texts(ws: Column, sizes: tuple[int, ...] = (WORDS,)) -> Column:
    return _shingles(ws, sizes, lambda parts: F.concat_ws(" ", *parts))


def _own_size(ws: Column, shingles) -> Column:
    """`shingles` of an item's words, of as many words as a short item has."""
    out = shingles(ws, (WORDS,))
    for k in range(1, WORDS):
        out = F.when(F.size(ws) == k, shingles(ws, (k,))).otherwise(out)
    return out


def index(benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`item_id, h`: each item's sketch. Items without words have none and are never found."""
    sets = benchmark.select("item_id", words(F.col("text")).alias("ws")).select("item_id", _own_size(F.col("ws"), shingle_hashes).alias("hs")).where(F.size("hs") > 0)
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.size("hs"))) + 1) - 1  # of the size class
    keep = F.least(F.size("hs"), (F.floor(upper * (1 - threshold) + 1e-9) + 1).cast("int"))
    return sets.select("item_id", F.explode(F.slice(F.array_sort("hs"), F.lit(1), keep)).alias("h")).distinct()


def find(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, item_id, n_shared, containment` of each document and item with containment >= threshold.

    Null ids are left out, null or empty texts contain nothing and are in nothing;
    of rows with the same id the highest containment counts. Texts of any length
    are read whole, and one that holds several items is cut into shingles once.
    `doc_id` may be of any type that can be grouped. The index is broadcast only if
    its written size is small; else both joins shuffle by hash and by id.
    """
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    items = benchmark.where("item_id is not null").select("item_id", "text")
    held = items.select(F.size(words(F.col("text"))).alias("n")).where(f"n between 1 and {WORDS - 1}").distinct().collect()  # four rows at most
    sizes = (*sorted(r.n for r in held), WORDS)
    sketch = Table(index(items, threshold), "items")
    small = (lambda t: F.broadcast(t.df) if t.small() else t.df)
    probes = docs.select("doc_id", words(F.col("text")).alias("ws")).select("doc_id", F.explode(shingle_hashes(F.col("ws"), sizes)).alias("h"))
    found = Table(probes.join(small(sketch), "h").groupBy("doc_id").agg(F.collect_set("item_id").alias("items")), "candidates")
    left = docs.join(small(found), "doc_id").select("doc_id", "items", words(F.col("text")).alias("ws"))
    left = left.select("doc_id", "items", shingle_texts(F.col("ws"), sizes).alias("ds")).select("doc_id", "ds", F.explode("items").alias("item_id"))
    right = items.select("item_id", words(F.col("text")).alias("ws")).select("item_id", _own_size(F.col("ws"), shingle_texts).alias("s"))
    right = Table(right, "shingles")
    shared = F.size(F.array_intersect("s", "ds"))
    both = left.join(small(right), "item_id").select("doc_id", "item_id", shared.cast("long").alias("n_shared"), (shared / F.size("s")).alias("containment"))
    return both.where(F.col("containment") >= threshold).groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("containment").alias("containment"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
 iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
 k AS (SELECT DISTINCT least(len(ws), 5) AS k FROM iw WHERE len(ws) > 0),
 ds AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + k - 1) AS s FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, k)),
 its AS (SELECT DISTINCT item_id, list_slice(ws, i, i + k - 1) AS s FROM (SELECT item_id, ws, least(len(ws), 5) AS k, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS i FROM iw WHERE len(ws) > 0)),
 n AS (SELECT item_id, count(*) AS n FROM its GROUP BY item_id),
 hit AS (SELECT doc_id, item_id, count(*) AS c FROM ds JOIN its USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, c AS n_shared, c / n AS containment FROM hit JOIN n USING (item_id) WHERE c / n >= 0.8
"""
