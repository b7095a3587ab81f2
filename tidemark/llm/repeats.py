"""Operator 2: removal of repeated byte strings through run-length compressed suffix indexes.

Every byte covered by a string of `LENGTH` bytes that starts at two places of the
corpus is removed. The corpus is cut so that equal windows meet: each window of
LENGTH bytes has an anchor, its smallest `GRAM`-byte hash (the leftmost of equal
ones), and the windows of one anchor form a segment of the text. Equal windows
have equal anchors, and each window is in exactly one segment. Only segments
whose anchor occurs twice go on, each distinct one once with its count.

Per block of whole anchor groups the distinct segments are indexed: a suffix array
gives the Burrows-Wheeler transform, kept as runs, with suffix and neighbour-match
samples at run starts and run ends only. Streaming over the text, the match length
with another place falls by one a byte from the last sample, so r samples give the
matching statistics of the whole block; windows with a match of LENGTH or more, or
in a segment that occurs twice, are marked.

Anchors, texts and marks meet by shuffles on the anchor and on the document. An
anchor in more than `HOT` places is refined by what surrounds it, to pieces of at
most `PIECE` windows; equal segments are pre-aggregated. If more than `CROWD`
different pieces still share their key, they are refined to single windows: such a
piece is marked by its count alone, and no task holds a crowd. Segments and windows
are told apart by 64-bit digests within an anchor, and by 128 bits in a crowd.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Table, release
from .shingles import U64, chunks, mix, slices

LENGTH = 200
GRAM = 96
#: Places of an anchor beyond which its segments are cut into pieces of `PIECE` windows, keyed by the bytes that these share.
HOT = 4096
PIECE = 16
#: Different pieces with one key beyond which they are cut into single windows.
CROWD = 4096
#: Bytes of distinct segments that one index holds.
BLOCK = 1 << 20
_B = U64(0x9E3779B97F4A7C15)
_PLACE = 30  # bits of a place in a chunk


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of every GRAM-byte string: doubling sums, no powers of the place."""
    h = mix(buf.astype(U64) + U64(1))
    out, have, size = None, 0, 1
    while True:
        if GRAM & size:
            n = len(buf) - have - size + 1
            out = h.copy() if out is None else mix(out[:n] * _B + h[have : have + n])
            have += size
        size *= 2
        if size > GRAM:
            return out
        n = len(h) - size // 2
        h = mix(h[:n] * _B + h[size // 2 :][:n])


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    n = len(x)
    pad = -n % w
    full = np.concatenate((x, np.full(pad, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, w)
    left = np.minimum.accumulate(full, 1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def anchors(held: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text: anchor hash, its place, first window and number of windows of its segments."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.int32))
    buf = np.frombuffer(b"".join(held), np.uint8)
    if len(buf) < LENGTH:
        yield from (none for _ in held)
        return
    h = _gram_hashes(buf)
    place = np.arange(len(h), dtype=U64) & U64((1 << _PLACE) - 1)
    low = _window_min(h >> U64(_PLACE) << U64(_PLACE) | place, LENGTH - GRAM + 1)
    at = 0
    for b in held:
        if len(b) < LENGTH:
            yield none
        else:
            own = low[at : at + len(b) - LENGTH + 1]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            n = np.diff(np.concatenate((first, [len(own)])))
            spot = (own[first] & U64((1 << _PLACE) - 1)).astype(np.int64)
            spot += (at + first - spot) + (GRAM << 4) >> _PLACE << _PLACE  # chunks beyond 2^30 bytes
            yield h[spot].view(np.int64), (spot - at).astype(np.int32), first.astype(np.int32), n.astype(np.int32)
        at += len(b)


class RunIndex:
    """Run-length compressed Burrows-Wheeler transform of segments, each ended by a mark of its own."""

    def __init__(self, segments: list[bytes]):
        m = len(segments)
        sizes = np.fromiter(map(len, segments), np.int64, m) + 1
        ends = np.cumsum(sizes)
        sym = np.frombuffer(b"\0".join([*segments, b""]), np.uint8).astype(np.int64) + m
        sym[ends - 1] = np.arange(m)
        n, base = len(sym), m + 256
        pad = np.concatenate((sym, np.zeros(3, np.int64))).astype(U64)
        step = 4 if base < 1 << 16 else 2
        key = pad[:n]
        for j in range(1, step):
            key = key * U64(base) + pad[j : n + j]
        order = np.argsort(key)
        rank = np.empty(n, np.int64)  # the first row of those with the same prefix of `width` symbols
        rows, part = np.arange(n), key[order]
        levels, width = [], step
        while True:
            head = np.concatenate(([True], part[1:] != part[:-1]))
            rank[order[rows]] = rows[np.maximum.accumulate(np.where(head, np.arange(len(rows)), 0))]
            alone = head & np.concatenate((head[1:], [True]))
            rows = rows[~alone]
            if not len(rows):
                break
            levels.append((width, rank.astype(np.int32)))
            at = order[rows]  # only what is still alike is sorted on
            after = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
            part = rank[at] * (n + 1) + after
            by = np.argsort(part)
            order[rows], part = at[by], part[by]
            width *= 2
        before = sym[order - 1]
        cut = np.flatnonzero(before[1:] != before[:-1]) + 1
        #: The runs: symbol, first row, and the text places at their two ends.
        self.starts = np.concatenate(([0], cut))
        self.heads = before[self.starts]
        self.first, self.last = order[self.starts], order[np.concatenate((cut, [n])) - 1]
        #: Common prefix with the row above at each run start, with the row below at each run end.
        self.above = np.concatenate(([0], self._common(order[cut - 1], order[cut], levels, sym)))
        self.below = np.concatenate((self.above[1:], [0]))
        self.n, self.ends = n, ends

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray, levels: list, sym: np.ndarray) -> np.ndarray:
        n, out = len(sym), np.zeros(len(a), np.int64)
        for width, rank in reversed(levels):
            x, y = a + out, b + out
            fits = np.maximum(x, y) < n
            same = fits & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
            out[same] += width
        for _ in range(levels[0][0] if levels else 4):
            x, y = a + out, b + out
            same = (np.maximum(x, y) < n) & (sym[np.minimum(x, n - 1)] == sym[np.minimum(y, n - 1)])
            out[same] += 1
        return out

    def match_lengths(self) -> np.ndarray:
        """For every place the length of its longest match with another place, streamed from the samples."""
        at = np.arange(self.n)
        best = np.zeros(self.n, np.int64)
        for place, length in ((self.first, self.above), (self.last, self.below)):
            until = np.zeros(self.n, np.int64)
            sampled = np.zeros(self.n, np.int64)
            until[place] = place + length
            sampled[place] = place
            best = np.maximum(best, until[np.maximum.accumulate(sampled)] - at)
        return best


def marks(segments: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """For each distinct segment which of its windows start anywhere else too."""
    index = RunIndex(segments)
    length = index.match_lengths()
    out, lo = [], 0
    for s, c, hi in zip(segments, counts, index.ends.tolist(), strict=True):
        n = len(s) - LENGTH + 1
        out.append(np.ones(n, bool) if c > 1 else length[lo : lo + n] >= LENGTH)
        lo = hi
    return out


def _digest(b: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True)


_INVERSE = pow(int(_B), -1, 1 << 64)


def _span_digests(b: bytes, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit digests of stretches of a text, each by two prefix sums."""
    up = np.full(len(b), _B, U64)
    up[0] = 1
    down = np.full(int(lo.max()) + 1, _INVERSE, U64)
    down[0] = 1
    sums = np.zeros(len(b) + 1, U64)
    np.cumsum(mix(np.frombuffer(b, np.uint8).astype(U64) + U64(1)) * np.multiply.accumulate(up), out=sums[1:])
    down = np.multiply.accumulate(down)
    return mix((sums[lo + size] - sums[lo]) * down[lo] + size.astype(U64))


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(flags, prepend=False, append=False))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _anchors(src: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [x for _, held in chunks(batch.column(2).to_pylist()) for x in anchors(held)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([x[i] for x in got], pa.list_(k)) for i, k in enumerate(kinds)]], ["id", "tag", "h", "spot", "first", "n"])

    return src.mapInArrow(run, "id bigint, tag bigint, h array<bigint>, spot array<int>, first array<int>, n array<int>")


def _segments(rows: DataFrame) -> DataFrame:
    """`h, d, first, n, id, tag, seg` from `id, tag, text` and arrays `h, spot, first, n, hot`; the bytes come once for each (h, d) of a task, or more often."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    names = ["h", "d", "first", "n", "id", "tag", "seg"]

    def of(text: str, h: np.ndarray, spot: np.ndarray, first: np.ndarray, n: np.ndarray, hot: np.ndarray, seen: set):
        b = text.encode("utf-8", "surrogatepass")
        if hot.any():
            cut = [p for a in zip(h[hot].tolist(), spot[hot].tolist(), first[hot].tolist(), n[hot].tolist(), strict=True) for p in _pieces(b, *a)]
            more = [np.array(c, np.int64) for c in zip(*cut, strict=True)]
            h, first, n = (np.concatenate((x[~hot], y)) for x, y in zip((h, first, n), more, strict=True))
        d = _span_digests(b, first, n + LENGTH - 1).view(np.int64)
        segs: list[bytes | None] = [None] * len(h)
        for i, key in enumerate((h * 3 ^ d).tolist()):
            if key not in seen:
                seen.add(key)
                segs[i] = b[first[i] : first[i] + n[i] + LENGTH - 1]
        return h, d, first, n, segs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, 200):
            out: list[tuple] = []
            arrays = [batch.column(i) for i in range(3, 8)]
            for r, (ident, tag, text) in enumerate(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)):
                h, spot, first, n, hot = (a[r].values.to_numpy(zero_copy_only=False) for a in arrays)
                if len(seen) > 400_000:
                    seen.clear()
                got = of(text, h, spot.astype(np.int64), first.astype(np.int64), n.astype(np.int64), hot.astype(bool), seen)
                out.append((*got[:4], [ident] * len(got[0]), [tag] * len(got[0]), got[4]))
            if out:
                cols = [np.concatenate([o[i] for o in out]) for i in range(4)] + [[v for o in out for v in o[i]] for i in range(4, 7)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return rows.mapInArrow(run, "h bigint, d bigint, first int, n int, id bigint, tag bigint, seg binary")


def _pieces(b: bytes, h: int, spot: int, first: int, n: int) -> Iterator[tuple[int, int, int]]:
    """A hot anchor's windows by their distance to it, PIECE at a time, keyed by the bytes that all of a piece have."""
    lo = first
    while lo < first + n:
        q = (spot - lo) // PIECE  # windows with this quotient begin at spot - PIECE * q - PIECE + 1 or later
        hi = min(spot - PIECE * q, first + n - 1)
        core = spot - PIECE * q
        yield _digest(h.to_bytes(8, "little", signed=True) + q.to_bytes(4, "little") + b[core : core + LENGTH - PIECE + 1]), lo, hi - lo + 1
        lo = hi + 1


def _marked(groups: DataFrame) -> DataFrame:
    """`h, d, spans array<struct<lo,hi>>`: marked windows of the distinct segments in rows `h, d, c, seg` sorted by h."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        # equal windows have one key, so a segment that is alone under its key has nothing to be looked up: its count decides
        of = Counter(r[0] for r in rows)
        asked = [i for i, r in enumerate(rows) if of[r[0]] > 1]
        found = [[(0, len(r[3]) - LENGTH + 1)] if r[2] > 1 else [] for r in rows]
        for i, f in zip(asked, marks([rows[i][3] for i in asked], [rows[i][2] for i in asked]) if asked else [], strict=True):
            found[i] = _runs(f)
        keep = [(r, f) for r, f in zip(rows, found, strict=True) if f]
        spans = [[{"lo": a, "hi": z} for a, z in f] for _, f in keep]
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r, _ in keep], pa.int64()), pa.array([r[1] for r, _ in keep], pa.int64()), pa.array(spans, kind)], ["h", "d", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size > BLOCK and row[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        yield flush(held)

    return groups.mapInArrow(run, "h bigint, d bigint, spans array<struct<lo:int,hi:int>>")


def _crowds(seen: DataFrame) -> Table:
    """`h` of the keys that more than CROWD different segments have; they are told apart only if a key has so many at all."""
    often = Table(seen.groupBy("h").count().where(F.col("count") > CROWD).select("h"), "often")
    rows = seen.select("h", "d") if not often.df.isEmpty() else seen.select("h", "d").where("false")
    out = Table(rows.groupBy("h", "d").agg(F.lit(1).alias("one")).groupBy("h").count().where(F.col("count") > CROWD).select("h"), "crowds")
    often.drop()
    return out


def _single_windows(groups: DataFrame) -> DataFrame:
    """`_marked` of rows `h, d, c, seg` by single windows: those that start in more than one place, each a span."""
    window = lambda j: F.substring(F.col("seg"), j + 1, F.lit(LENGTH))
    places = F.sequence(F.lit(0), F.octet_length("seg") - LENGTH)
    each = groups.select("h", "d", "c", F.posexplode(F.transform(places, lambda j: F.struct(F.xxhash64(window(j)).alias("a"), F.xxhash64(F.lit(1), window(j)).alias("b")))).alias("j", "w"))
    often = Table(each.groupBy("w.a", "w.b").agg(F.sum("c").alias("n")).where("n > 1").select("a", "b"), "windows")
    met = each.join(often.df, (F.col("w.a") == often.df["a"]) & (F.col("w.b") == often.df["b"]), "left_semi")
    spans = F.transform(F.sort_array(F.collect_set("j")), lambda j: F.struct(j.alias("lo"), (j + 1).alias("hi")))
    return met.groupBy("h", "d").agg(spans.alias("spans"))


def _cut(rows: DataFrame, keep_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            for r, (ident, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                b = text.encode("utf-8", "surrogatepass")
                gone = np.zeros(len(b) + 1, np.int32)
                if batch.column(2)[r].is_valid:
                    np.add.at(gone, batch.column(2)[r].values.to_numpy(), 1)
                    np.add.at(gone, batch.column(3)[r].values.to_numpy() + (LENGTH - 1), -1)
                runs = _runs(np.cumsum(gone)[:-1] > 0)
                kept, at = [], 0
                for lo, hi in runs:
                    kept.append(b[at:lo])
                    at = hi
                kept = b"".join([*kept, b[at:]])
                out.append((ident, len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256` and `kept binary` (null without `keep_text`) of every row.

    Repeats are judged on the input, across and within documents, and never cross
    documents. A null text is an empty one; texts under LENGTH bytes stay whole.
    Null and equal ids are allowed, and rows that are equal in id and text are
    copies of each other. Further columns are dropped.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    src = src.select("id", F.xxhash64("text", "id").alias("tag"), "text")
    long = src.where(F.octet_length("text") >= LENGTH)
    found = Table(_anchors(long), "anchors")
    # written, so that Spark may split a hot anchor of the join
    counts = Table(found.df.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    each = found.df.select("id", "tag", F.explode(F.arrays_zip("h", "spot", "first", "n")).alias("a"))
    each = each.select("id", "tag", "a.h", "a.spot", "a.first", "a.n").join(counts.df.select("h", (F.col("c") > HOT).alias("hot")), "h")
    # rows equal in id and text share a tag; both are counted, and both get the marks
    per_doc = each.groupBy("id", "tag").agg(F.collect_set(F.struct("h", "spot", "first", "n", "hot")).alias("f"))
    per_doc = Table(per_doc.select(F.col("id").alias("__id"), F.col("tag").alias("__tag"), *[F.col(f"f.{c}").alias(c) for c in ("h", "spot", "first", "n", "hot")]), "repeated")
    found.drop()
    counts.drop()
    same = (F.col("tag") == F.col("__tag")) & F.col("id").eqNullSafe(F.col("__id"))
    rows = long.join(per_doc.df, same).select("id", "tag", "text", "h", "spot", "first", "n", "hot")
    seen = Table(_segments(rows), "segments")
    per_doc.drop()
    groups = seen.df.groupBy("h", "d").agg(F.count("*").alias("c"), F.first("seg", ignorenulls=True).alias("seg"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crowds = _crowds(seen.df)
    if crowds.df.isEmpty():
        marks_of = _marked(groups.repartition(n, "h").sortWithinPartitions("h"))
    else:
        crowded = F.broadcast(crowds.df) if crowds.small() else crowds.df
        marks_of = _marked(groups.join(crowded, "h", "left_anti").repartition(n, "h").sortWithinPartitions("h")).unionByName(_single_windows(groups.join(crowded, "h", "left_semi")))
    marked = Table(marks_of, "marks")
    spans = seen.df.select("h", "d", "first", "id", "tag").join(marked.df, ["h", "d"]).select("id", "tag", "first", F.explode("spans").alias("s"))
    spans = spans.groupBy(F.col("id").alias("__id"), F.col("tag").alias("__tag")).agg(F.collect_list(F.struct((F.col("s.lo") + F.col("first")).alias("lo"), (F.col("s.hi") + F.col("first")).alias("hi"))).alias("s"))
    spans = Table(spans.select("__id", "__tag", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")), "spans")
    seen.drop()
    marked.drop()
    crowds.drop()
    release(docs.sparkSession)
    result = _cut(src.join(spans.df, same, "left").select(F.col("id").alias("doc_id"), "text", "lo", "hi"), keep_text)
    return result if keep_text else result.drop("kept")
