"""Operator 8: licence scan by Dice coefficient over word bigrams.

Texts and templates are lower-cased and cut into words of letters and digits.
A text is compared with each template through all windows that begin and end at a
bigram that it shares with it; to cut others from an end lowers no Dice. Size bounds
prune first: at threshold t a set of a bigrams can only match one of b if
t / (2 - t) <= a / b <= (2 - t) / t, and it must share t * b / (2 - t) of them.
A window whose first bigram comes again inside it is the same set without its
first one, so windows (but for those of at most the template's length) end before
that; each place of the text then lies in at most (2 - t) / t * b windows' starts.
One pass, no shuffle; the templates are a fixed table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .licence_texts import TEMPLATES
from .shingles import U64, chunks, mix, slices, word_hashes

THRESHOLD = 0.8
_C0, _C1 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def bigrams(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offset of every word and hash of every word bigram; bytes other than letters, digits and non-ASCII part words."""
    low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf)
    low = np.where((low >= 0x80) | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)), low, 32).astype(np.uint8)
    at, w = word_hashes(low)
    if len(w) < 2:
        return at, np.zeros(0, U64)
    return at, mix(w[:-1] * _C0 + w[1:] * _C1)


class Templates:
    def __init__(self, texts: dict[str, str], threshold: float = THRESHOLD):
        self.names = sorted(texts)
        self.threshold = threshold
        sets = [np.unique(bigrams(np.frombuffer(texts[n].encode(), np.uint8))[1]) for n in self.names]
        self.lengths = [len(bigrams(np.frombuffer(texts[n].encode(), np.uint8))[1]) for n in self.names]
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        self.all = np.unique(np.concatenate(sets))
        #: Which templates have a bigram, and how many of a text's they must share.
        self.member = np.stack([np.isin(self.all, s, assume_unique=True) for s in sets], axis=1)
        self.least = self.sizes * threshold / (2 - threshold)

    def best(self, grams: np.ndarray) -> list[tuple[str, float, int, int]]:
        """Name, Dice, first bigram and number of bigrams of each template's best place in a text, if it reaches the threshold."""
        t, out = self.threshold, []
        if not len(grams):
            return out
        place = np.minimum(np.searchsorted(self.all, grams), len(self.all) - 1)
        known = self.all[place] == grams
        enough = self.member[np.unique(place[known])].sum(0) >= self.least  # else even the whole text shares too little
        near = None
        for k in np.flatnonzero(enough).tolist():
            name, m, length = self.names[k], self.sizes[k], self.lengths[k]
            least, most = self.least[k], m * (2 - t) / t
            shared = known & self.member[place, k]
            hit = np.flatnonzero(shared)
            if near is None:
                near = _neighbours(grams)
            before, after = near
            top = (0.0, 0, 0)
            ends = _ends(before, after, int(most + 1e-9))
            ends = np.minimum(ends[hit], np.maximum(after[hit], hit + length))
            inside = np.searchsorted(hit, ends) - np.arange(len(hit))
            for i, j in zip(hit[inside >= least].tolist(), ends[inside >= least].tolist(), strict=True):
                new = before[i:j] < i
                dice = 2 * np.cumsum(new & shared[i:j]) / (np.cumsum(new) + m)
                dice[~shared[i:j]] = 0
                same = np.flatnonzero(dice == dice.max())  # of equal ones the longest within the template's length, else the shortest
                end = int(same[max(0, np.searchsorted(same, length) - 1)])
                top = max(top, (float(dice[end]), -i, end + 1))
                if top[0] == 1.0:  # of equal ones the first counts
                    break
            if top[0] >= t:
                out.append((name, top[0], -top[1], top[2]))
        return out


def _neighbours(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the same bigram's last occurrence before each place (-1 without one) and of its next one (the text's length)."""
    by = np.argsort(grams, kind="stable")
    same = grams[by[1:]] == grams[by[:-1]]
    before, after = np.full(len(grams), -1), np.full(len(grams), len(grams))
    before[by[1:][same]] = by[:-1][same]
    after[by[:-1][same]] = by[1:][same]
    return before, after


def _ends(before: np.ndarray, after: np.ndarray, most: int) -> np.ndarray:
    """For each place the end of the longest window from it with at most `most` distinct bigrams."""
    n, j, held, out = len(before), 0, 0, []
    first, then = before.tolist(), after.tolist()
    for i in range(n):
        while j < n and held + (first[j] < i) <= most:
            held += first[j] < i
            j += 1
        out.append(j)
        held -= then[i] >= j  # else its next occurrence counts
    return np.array(out, np.int64)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """For every row: `doc_id, licence, dice, n_licences, licences array<struct<licence,dice,first_word,n_words>>`.

    `licence` is the best match (highest Dice, then the longer, then the first
    name), null without one; a null or empty text has none. Equal rows get equal
    results, no row depends on others, and texts of any length are compared whole;
    an empty table gives one.
    """
    texts = docs.sparkSession.sparkContext.broadcast(TEMPLATES if templates is None else templates)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(texts.value, threshold)
        for batch in slices(batches):
            found: list[list[dict]] = []
            for _, held in chunks(batch.column(1).to_pylist()):
                ends = np.cumsum([len(b) + 1 for b in held])
                at, grams = bigrams(np.frombuffer(b"\n".join(held) + b"\n", np.uint8))
                place = np.minimum(np.searchsorted(known.all, grams), len(known.all) - 1)
                hits = np.bincount(np.searchsorted(ends, at[: len(grams)][known.all[place] == grams], "right"), minlength=len(held))
                cut = np.searchsorted(at, ends)
                lo = 0
                for i, hi in enumerate(cut.tolist()):
                    # the bigram that begins at a text's last word runs into the next text
                    own = grams[lo : max(lo, hi - 1)] if hits[i] else grams[:0]
                    found.append([{"licence": a, "dice": float(d), "first_word": int(f), "n_words": int(m) + 1} for a, d, f, m in known.best(own)])
                    lo = hi
            tops = [min(x, key=lambda r: (-r["dice"], -r["n_words"], r["licence"]), default=None) for x in found]
            kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("first_word", pa.int32()), ("n_words", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r and r["licence"] for r in tops], pa.string()), pa.array([r and r["dice"] for r in tops], pa.float64()), pa.array(map(len, found), pa.int32()), pa.array(found, kind)],
                ["doc_id", "licence", "dice", "n_licences", "licences"],
            )

    schema = "doc_id bigint, licence string, dice double, n_licences int, licences array<struct<licence:string,dice:double,first_word:int,n_words:int>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
