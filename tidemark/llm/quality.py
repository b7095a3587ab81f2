"""Operator 5: quality classifier by ordinal cumulative-link regression.

Grades are ordered: 0 toxic, 1 poor, 2 good. One weight vector over hashed text
features is shared by all grades, and ordered thresholds cut the latent score:
P(grade <= k) = sigmoid(threshold_k - w.x). A text gets its expected grade and
the tail probability P(grade = 2), by which documents are selected.

Features are hashed words, four-byte word heads, word shapes and repeats, each as
the square root of its share of the text's words. The fit uses at most
`max_labels` labelled rows (smallest hash of doc_id); scoring covers all rows in
one pass without a shuffle, with the weights (`DIM` floats) broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import U64, chunks, mix, slices, word_hashes

DIM = 1 << 18
#: Documented bound of the fit.
MAX_LABELS = 6000
#: Features in fewer training texts than this keep weight 0.
LEAST_TEXTS = 4
STEPS = 250
DECAY = 2e-5
CUT = 0.5


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """For some texts at a time: text number within them, feature, value, and how many texts."""
    for _, held in chunks(texts):
        buf = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
        ends = np.cumsum([len(b) + 1 for b in held])
        low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
        letters = np.where((low >= 0x80) | ((low >= 97) & (low <= 122)), low, 32).astype(np.uint8)
        parts = []
        at, words = word_hashes(letters)
        if len(at):
            head = np.zeros(len(at), U64)
            padded = np.concatenate((letters, np.full(4, 32, np.uint8))).astype(U64)
            open_ = np.ones(len(at), bool)
            for j in range(4):
                c = padded[at + j]
                open_ &= c != 32
                head = head * U64(257) + np.where(open_, c, U64(0))
            of = np.searchsorted(ends, at, "right")
            same = np.concatenate(([False], (words[1:] == words[:-1]) & (of[1:] == of[:-1])))
            parts += [(at, words), (at, mix(head + U64(11 << 40))), (at[same], np.full(same.sum(), 7, U64))]
        at, _ = word_hashes(buf)
        if len(at):
            blank = np.flatnonzero((buf == 32) | ((buf >= 9) & (buf <= 13)))
            last = buf[blank[np.searchsorted(blank, at)] - 1].astype(U64)  # a mark behind each text ends its last word
            upper = ((buf[at] >= 65) & (buf[at] <= 90)).astype(U64) + 2 * ((buf[np.minimum(at + 1, len(buf) - 1)] >= 65) & (buf[np.minimum(at + 1, len(buf) - 1)] <= 90)).astype(U64)
            mark = np.where((last >= 97) & (last <= 122) | (last >= 0x80), U64(1), last)
            parts.append((at, mix(mark * U64(4) + upper + U64(13 << 40))))
        if not parts:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), len(held)
            continue
        doc = np.searchsorted(ends, np.concatenate([p[0] for p in parts]), "right")
        f = (np.concatenate([p[1] for p in parts]) >> U64(64 - 18)).astype(np.int64)
        key, n = np.unique(doc * DIM + f, return_counts=True)
        total = np.bincount(doc, minlength=len(held))
        yield key // DIM, key % DIM, np.sqrt(n / total[key // DIM]), len(held)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the top grade."""
        latent = [np.zeros(0)]
        for doc, f, v, n in features(texts):
            latent.append(np.bincount(doc, v * self.weights[f], n))
        above = _sigmoid(np.concatenate(latent)[:, None] - self.thresholds)
        return above.sum(1), above[:, -1]


def train(doc: np.ndarray, feat: np.ndarray, val: np.ndarray, grade: np.ndarray, grades: int = 3) -> Model:
    """Adam on the cumulative-link likelihood; gaps between thresholds are exponentials, so they stay ordered."""
    n = len(grade)
    texts = np.bincount(feat, minlength=DIM)
    keep = texts[feat] >= LEAST_TEXTS
    doc, val = doc[keep], val[keep]
    used, feat = np.unique(feat[keep], return_inverse=True)
    share = np.clip([(grade <= k).mean() if n else 0.5 for k in range(grades - 1)], 0.01, 0.99)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    p = np.concatenate((np.zeros(len(used)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))))
    m, s = np.zeros_like(p), np.zeros_like(p)
    w_n = len(used)
    for step in range(1, STEPS + 1 if n else 1):
        w = p[:w_n]
        gaps = np.exp(p[w_n + 1 :])
        th = p[w_n] + np.concatenate(([0], np.cumsum(gaps)))
        z = np.bincount(doc, val * w[feat], n)
        up = _sigmoid(np.concatenate((th, [40]))[grade] - z)
        dn = np.where(grade > 0, _sigmoid(th[np.maximum(grade - 1, 0)] - z), 0.0)
        mass = np.maximum(up - dn, 1e-9)
        g_up, g_dn = up * (1 - up) / mass, dn * (1 - dn) / mass
        g_z = (g_up - g_dn) / n  # of the negative log likelihood
        g_th = np.zeros(grades - 1)
        for k in range(grades - 1):
            g_th[k] = (-g_up[grade == k].sum() + g_dn[grade == k + 1].sum()) / n
        g = np.concatenate((np.bincount(feat, val * g_z[doc], w_n) + DECAY * w, [g_th.sum()], [g_th[k + 1 :].sum() * gaps[k] for k in range(grades - 2)]))
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DIM)
    weights[used] = p[:w_n]
    return Model(weights, p[w_n] + np.concatenate(([0], np.cumsum(np.exp(p[w_n + 1 :])))))


def grades(labels: DataFrame) -> DataFrame:
    """`doc_id, grade` from `doc_id, quality, toxic`: 0 toxic, else 1 poor, 2 good; the lowest of a document's rows; null ids and rows without a rating are left out."""
    g = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", g.alias("grade")).where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, graded: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    """`graded` has `doc_id, grade`; at most `max_labels` of its rows are used, with the first text in order of each id. Without rows every text gets the same score."""
    chosen = graded.select("doc_id", "grade").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_labels rows
    sample = sample.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))  # one row an id, however often it stands there

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            idx, val = [], []
            for doc, f, v, n in features(batch.column(1).to_pylist()):
                cut = np.searchsorted(doc, np.arange(1, n))
                idx += np.split(f.astype(np.int32), cut)
                val += np.split(v.astype(np.float32), cut)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float32()))], ["doc_id", "grade", "idx", "val"])

    got = sample.select("doc_id", "text", "grade").mapInArrow(vectors, "doc_id bigint, grade int, idx array<int>, val array<float>").toArrow().combine_chunks().sort_by("doc_id")
    if not got.num_rows:
        return Model(np.zeros(DIM), np.array([-1.0, 0.0]))
    sizes = pa.compute.list_value_length(got["idx"]).to_numpy()
    flat = lambda c: pa.compute.list_flatten(got[c]).to_numpy()
    return train(np.repeat(np.arange(got.num_rows), sizes), flat("idx").astype(np.int64), flat("val").astype(float), got["grade"].to_numpy().astype(int))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The input's columns with `expected_grade double, p_good double`; columns of these names are replaced.

    A null text is an empty one, and an empty one has no features: its score comes from the thresholds alone.
    Equal texts get equal scores, texts of any length are read whole, an empty table gives one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("expected_grade", "p_good")]
    src = docs.select(*names)
    text = names.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema) + ", expected_grade double, p_good double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            mean, top = shared.value.score(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mean), pa.array(top)], [*names, "expected_grade", "p_good"])

    return src.mapInArrow(run, schema)


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """`score` with `kept boolean`: whether the top grade is at least as likely as not."""
    return score(docs, model).withColumn("kept", F.col("p_good") >= CUT)
