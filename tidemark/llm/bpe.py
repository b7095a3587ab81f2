"""Operator 1: byte-level BPE encoding and decoding by a pair occurrence index.

The distinct pieces of a batch of whole texts are laid out in one symbol array.
An index maps each pair that the merge table knows to all its positions there;
active ranks are taken in ascending order, every live position of a rank is
merged, and the lists of the pairs that this makes or breaks are updated. The
pieces' ids are kept between batches in a table bounded by its bytes, so common
pieces are merged once per task.

No shuffle: one pass over the input, memory bounded by an Arrow batch and the
piece table. Nulls are empty texts. Special tokens' strings in a text give their
ids, as the tokenizers library does by default.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import slices, trim

#: Bytes, about, that the chunks and pieces kept between batches take in each Python worker; a task's end frees them.
KEPT_BYTES = 96 << 20
#: Characters of the texts that are encoded together.
GROUP_CHARS = 1 << 20
#: The split of byte-level BPE with this vocabulary; a fixed value of the format.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _bytes(entry: tuple[str, tuple[int, ...]]) -> int:
    """What an entry of the tables takes, about: the objects' heads, the letters, the ids and their share of numbers."""
    return 200 + len(entry[0]) + 36 * len(entry[1])


class Codec:
    """Encoder and decoder of a byte-level BPE file of the tokenizers library."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model, pre = j["model"], j["pre_tokenizer"]
        if j.get("normalizer") or model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError("only byte-level BPE without normalizer and prefix space is supported")
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        vocab = model["vocab"]
        self.table: dict[int, bytes] = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        self.table |= {i: t.encode() for t, i in self.special.items()}
        self.first_of = np.array([vocab[c] for c in letters], np.int64)
        merges = dict.fromkeys(tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        #: By rank: left, right and merged symbol; and the same pairs sorted, to look ranks up.
        self.made = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        keys = np.array([a << 32 | b for a, b, _ in self.made], np.int64)
        self.rank_at = np.argsort(keys)
        self.keys = keys[self.rank_at]
        self.digits = {i: str(i) for i in self.table}
        self.split = regex.compile(SPLIT)
        self.odd = re.compile(r"\s\s|^\s|\s\Z")
        self.at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.forget()

    def forget(self) -> None:
        """Frees what is kept between batches."""
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; those that the merge table lacks have the table's length."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_at[at], len(self.made))

    def merge(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of each piece, all pieces merged together through one pair occurrence index."""
        coded = [p.encode("utf-8", "surrogatepass") for p in pieces]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
        stop = np.cumsum(sizes) - 1  # no pair crosses the mark behind a piece
        sym = self.first_of[np.frombuffer(b"\0".join([*coded, b""]), np.uint8)]
        sym[stop] = -1
        n = len(sym)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        # the index: positions sorted by rank, then place; what merges add stands in lists of arrays by rank
        rank = self._rank_of(sym[:-1], sym[1:]) if n > 1 else np.zeros(0, np.int64)
        live = np.flatnonzero(rank < len(self.made))
        order = live[np.argsort(rank[live], kind="stable")]
        sorted_ranks = rank[order]
        begin = np.flatnonzero(np.diff(sorted_ranks, prepend=-1))
        ranks = sorted_ranks[begin]
        index: dict[int, list[np.ndarray]] = dict(zip(ranks.tolist(), ([x] for x in np.split(order, begin[1:])), strict=True)) if len(ranks) else {}
        active = ranks.tolist()  # sorted, so a heap
        while active:
            r = heappop(active)
            lists = index.pop(r)
            a, b, new = self.made[r]
            at = np.sort(np.concatenate(lists))
            if len(at) > 1:
                at = at[np.concatenate(([True], at[1:] != at[:-1]))]
            nxt = after[at]
            ok = (sym[at] == a) & (sym[nxt] == b)
            at, nxt = at[ok], nxt[ok]
            if a == b and len(at) > 1:  # in a run of equal symbols from left to right, each symbol once
                keep, last = [], -1
                for i, j in zip(at.tolist(), nxt.tolist(), strict=True):
                    keep.append(i != last)
                    last = j if i != last else -1
                at, nxt = at[keep], nxt[keep]
            if not len(at):
                continue
            sym[at], sym[nxt] = new, -2
            follow = after[nxt]
            after[at], before[follow] = follow, at  # a mark always follows
            prior = before[at]
            first = np.concatenate((at, prior[prior >= 0]))
            rank = self._rank_of(sym[first], sym[after[first]])
            if not len(got := np.flatnonzero(rank < len(self.made))):
                continue
            first, rank = first[got], rank[got]
            if len(got) > 1:
                by = np.argsort(rank, kind="stable")
                first, rank = first[by], rank[by]
                cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
                groups = zip(rank[[0, *cut]].tolist(), np.split(first, cut), strict=True)
            else:
                groups = [(int(rank[0]), first)]
            for q, places in groups:
                if q in index:
                    index[q].append(places)
                else:
                    index[q] = [places]
                    heappush(active, q)
        left = sym >= 0
        ids = sym[left].tolist()
        ends = np.cumsum(left)[stop].tolist()
        return [tuple(ids[x:y]) for x, y in zip([0, *ends[:-1]], ends, strict=True)] if coded else []

    def _plain(self, chunk: str) -> list[str]:
        """Its pieces; letters after at most one space, and one mark behind them, need no pattern."""
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isalpha():
            return [chunk]
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [chunk[:-1], word[-1]]
        return self.split.findall(chunk)

    def _learn(self, chunks: set[str]) -> None:
        if self.held > KEPT_BYTES:  # what this batch uses stays
            stay = {c: self.chunks[c] for c in chunks if c in self.chunks}
            self.forget()
            self.chunks, self.held = stay, sum(map(_bytes, stay.items()))
        cut = {c: self._plain(c) for c in chunks if c not in self.chunks}
        fresh = list({p for ps in cut.values() for p in ps if p not in self.pieces})
        made = dict(zip(fresh, self.merge(fresh), strict=True))
        self.pieces.update(made)
        known = self.pieces
        whole = {c: known[ps[0]] if len(ps) == 1 else tuple(chain.from_iterable([known[p] for p in ps])) for c, ps in cut.items()}
        self.chunks.update(whole)
        self.held += sum(map(_bytes, made.items())) + sum(map(_bytes, whole.items()))

    def _cut(self, text: str) -> list[str]:
        """Chunks that the split never crosses: before each single space, if white space never stands beside white space."""
        if self.odd.search(text):
            return self.split.findall(text)
        parts = text.split(" ")
        return [parts[0], *[" " + p for p in parts[1:]]]

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        rows = []
        for t in texts:
            parts = self.at.split(t) if self.at else [t]
            rows.append([(i % 2, p if i % 2 else self._cut(p)) for i, p in enumerate(parts) if p])
        self._learn({c for row in rows for special, cs in row if not special for c in cs})
        known = self.chunks
        for row in rows:
            ids: list[int] = []
            for special, cs in row:
                if special:
                    ids.append(self.special[cs])
                else:
                    ids.extend(chain.from_iterable([known[c] for c in cs]))
            yield ids

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD."""
        table = self.table
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(spec)
    return _codecs[key]


def _groups(texts: list[str], limit: int = GROUP_CHARS) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size > limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """`keep` columns, `ids array<int>` (or none), `n_tokens`, `ids_sha256`, `decoded_sha256` of every row.

    `path` is a tokenizer file on the driver; it is read once and broadcast
    (a few MB, whatever the corpus). A null text is an empty one; input columns
    other than `keep` are dropped, so clashing names cannot arise.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    src = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    kinds = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{kinds}, " + "ids array<int>, " * with_ids + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in slices(batches):
            at = 0
            for texts in _groups([t or "" for t in batch.column(len(keep)).to_pylist()]):
                all_ids, n, a, b = [], [], [], []
                for ids in c.encode_batch(texts):
                    n.append(len(ids))
                    a.append(sha(",".join([c.digits[i] for i in ids])))
                    b.append(sha(c.decode(ids)))
                    if with_ids:
                        all_ids.append(pa.array(ids, pa.int32()))
                part = batch.slice(at, len(texts))
                at += len(texts)
                cols = [part.column(i) for i in range(len(keep))]
                names = list(keep)
                if with_ids:
                    offsets = pa.array([0, *_running(n)], pa.int32())
                    cols.append(pa.ListArray.from_arrays(offsets, pa.concat_arrays(all_ids) if all_ids else pa.array([], pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], [*names, "n_tokens", "ids_sha256", "decoded_sha256"])
        c.forget()  # Spark keeps the worker for other tasks
        trim()

    return src.mapInArrow(run, schema)


def _running(n: list[int]) -> list[int]:
    out, s = [], 0
    for x in n:
        s += x
        out.append(s)
    return out


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and `text` of every row of `ids array<int>`; null ids give a null text."""
    with open(path, encoding="utf-8") as f:
        spec = encoded.sparkSession.sparkContext.broadcast(f.read())
    src = encoded.select(*[F.col(c) for c in keep], F.col(ids).alias("__ids"))
    kinds = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for batch in slices(batches):
            texts = [None if x is None else c.decode(x) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(texts, pa.string())], [*keep, "text"])

    return src.mapInArrow(run, f"{kinds}, text string")
