"""Operator 3: language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of hashed byte trigrams of its letters.
Each language has several centroids from spherical k-means; a text takes the
language of the centroid with the highest cosine, and is marked rejected if that
cosine is below what all but a few of the centroid's own training texts reach.

The model is fitted on at most `per_lang` labelled rows of each language, the
ones with the smallest hash of doc_id; everything else covers all rows. One pass,
no shuffle of texts; the model (centroids x `DIM` floats) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Table
from .shingles import slices

DIM = 1 << 13
#: Documented bound of the fit: labelled rows of each language.
PER_LANG = 400
CENTROIDS = 4
ROUNDS = 12
#: Share of a centroid's own training texts that its rejection threshold may lose.
TAIL = 0.01
UNKNOWN = "und"
_CHUNK, _TEXTS = 2 << 20, 512


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def gram_counts(texts: list[str]) -> Iterator[np.ndarray]:
    """Rows of trigram counts, some texts at a time. Marks and digits are spaces; runs of spaces are one."""
    held, size = [], 0
    for t in texts:
        b = t.lower().encode("utf-8", "surrogatepass")
        held.append(b)
        size += len(b)
        if size > _CHUNK or len(held) == _TEXTS:
            yield _count(held)
            held, size = [], 0
    if held:
        yield _count(held)


def _count(held: list[bytes]) -> np.ndarray:
    n = len(held)
    buf = np.frombuffer(b" " + b"  ".join(held) + b" ", np.uint8)
    doc = np.repeat(np.arange(n), [len(b) + 2 for b in held])
    buf = np.where((buf >= 0x80) | ((buf >= 97) & (buf <= 122)), buf, 32).astype(np.uint8)
    stay = np.ones(len(buf), bool)
    stay[1:] = (buf[1:] != 32) | (buf[:-1] != 32) | (doc[1:] != doc[:-1])
    buf, doc = buf[stay].astype(np.uint32), doc[stay]
    out = np.zeros((n, DIM), np.float32)
    if len(buf) < 3:
        return out
    h = (buf[:-2] << np.uint32(16) | buf[1:-1] << np.uint32(8) | buf[2:]) * np.uint32(0x9E3779B1)
    key = doc[:-2] * DIM + (h >> np.uint32(19)).astype(np.int64)
    key = key[(doc[:-2] == doc[2:]) & ~((buf[:-2] == 32) & (buf[2:] == 32) & (buf[1:-1] == 32))]
    return np.bincount(key, minlength=n * DIM).reshape(n, DIM).astype(np.float32)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts, dtype=np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # cosine below which a text is rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        lang, score, rejected = [], [], []
        texts = [t or "" for t in texts]
        at = 0
        for counts in gram_counts(texts):
            cos = weigh(counts, self.idf) @ self.centroids.T if self.langs else np.zeros((len(counts), 0))
            for i, row in enumerate(cos):
                if not self.langs or not _has_letter(texts[at + i]):
                    lang.append(UNKNOWN), score.append(0.0), rejected.append(True)
                    continue
                k = int(np.argmax(row))
                lang.append(self.langs[k])
                score.append(float(min(1.0, max(0.0, row[k]))))
                rejected.append(bool(row[k] < self.least[k]))
            at += len(counts)
        return lang, score, rejected


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, seeded with the mean's nearest row and then the farthest rows."""
    k = min(k, len(x))
    seeds = [int(np.argmax(x @ x.mean(0)))]
    while len(seeds) < k:
        near = (x @ x[seeds].T).max(1)
        near[seeds] = 2
        seeds.append(int(np.argmin(near)))
    c = x[seeds]
    for _ in range(ROUNDS):
        own = np.argmax(x @ c.T, 1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(k)])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def train(counts: np.ndarray, langs: list[str], k: int = CENTROIDS) -> Model:
    names = sorted(set(langs))
    df = (counts > 0).sum(0)
    idf = (np.log((1 + len(counts)) / (1 + df)) + 1).astype(np.float32)
    x = weigh(counts, idf)
    of = np.array(langs)
    cents, owner, least = [], [], []
    for name in names:
        c = _cluster(x[of == name], k)
        cos = x[of == name] @ c.T
        own = np.argmax(cos, 1)
        for j in range(len(c)):
            mine = cos[own == j, j]
            cents.append(c[j])
            owner.append(name)
            least.append(0.8 * float(np.quantile(mine, TAIL)) if len(mine) else 0.0)
    return Model(owner, np.array(cents, np.float32).reshape(len(owner), DIM), idf, np.array(least))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Remainder 1 of crc32 of the id as text; a null id is not held out and not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """From `doc_id, text, lang`: at most `per_lang` ids of each language that are not held out, of each the first text in order."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    # a share of each language by hash first, so that few rows are ranked however many there are
    sizes = Table(rows.groupBy("lang").agg(F.count("*").alias("__n")), "languages")
    sizes = F.broadcast(sizes.df) if sizes.small() else sizes.df  # one row a language
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    some = rows.select("doc_id", "lang").join(sizes, "lang").where(spread / F.lit(float(1 << 30)) <= F.lit(4.0 * per_lang) / F.col("__n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(spread, "doc_id"))
    chosen = some.select("doc_id", "lang", rank.alias("__rank")).where(F.col("__rank") <= per_lang).select("doc_id", "lang").distinct()
    chosen = Table(chosen, "chosen")
    sample = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen.df) if chosen.small() else chosen.df, ["doc_id", "lang"])  # per_lang rows a language
    sample = sample.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))  # one row an id, however often it stands there

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            idx, val = [], []
            for counts in gram_counts(texts):
                for row in counts:
                    at = np.flatnonzero(row)
                    idx.append(at.astype(np.int16))
                    val.append(row[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(idx, pa.list_(pa.int16())), pa.array(val, pa.list_(pa.float32()))], ["doc_id", "lang", "idx", "val"])

    got = sample.mapInArrow(vectors, "doc_id bigint, lang string, idx array<smallint>, val array<float>").toArrow().sort_by("doc_id")
    got = got.filter(pa.compute.greater(pa.compute.list_value_length(got["idx"]), 0))
    counts = np.zeros((got.num_rows, DIM), np.float32)
    for i, (at, v) in enumerate(zip(got["idx"].to_pylist(), got["val"].to_pylist(), strict=True)):
        counts[i, at] = v
    return train(counts, got["lang"].to_pylist())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, held_out, lang_pred, score, rejected` of every row; only the text is used to predict.

    A text that is null, empty or without a letter gives `und`, 0 and rejected;
    so does any text if no labelled row was there to learn from. Rows that are
    equal get equal results, texts of any length are read whole, an empty table
    gives one; columns other than `doc_id` and `text` are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            lang, score, rejected = m.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return src.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")
