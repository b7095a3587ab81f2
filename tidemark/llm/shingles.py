"""Vectorised hashing of words and word shingles over a batch of texts.

Texts are UTF-8 bytes; a word is a run of bytes other than space and 0x09-0x0D;
A-Z are lower-cased. Hashes are 64 bits. No text is cut: memory is a few times
the bytes of one chunk, and one chunk holds whole texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim  # noqa: B018  glibc has it, other libraries may not
except (OSError, AttributeError):
    _libc = None

U64 = np.uint64
CHUNK_BYTES = 1 << 19
_MULT = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Powers of an odd number: a byte's weight by its place in its word; places beyond the table wrap.
_SPAN = 1 << 12


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = mix(_powers(_SPAN, 0x9E3779B97F4A7C15)) | U64(1)


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word of a byte array."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    ink = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    edge = np.flatnonzero(np.diff(ink, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(U64)
    place = np.arange(len(buf), dtype=np.int64)
    place -= np.repeat(starts, np.diff(np.concatenate(([0], starts[1:], [len(buf)]))))  # what stands before the first word has no value
    wraps = place >= _SPAN
    weight = _POW[place & (_SPAN - 1)]
    if wraps.any():  # words longer than the table: the lap counts too
        weight = np.where(wraps, mix(weight + (place >> 12).astype(U64)), weight)
    val = mix((low + U64(1)) * weight)
    val[~ink] = 0
    with np.errstate(over="ignore"):
        h = np.add.reduceat(val, starts)
    return starts, mix(h + (ends - starts).astype(U64))


def trim() -> None:
    """Gives freed memory back to the system: Spark keeps its Python workers, and allocators keep what a batch took."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def slices(batches: Iterator, rows: int = 500) -> Iterator:
    """Arrow batches cut to fewer rows, so that what is made of one at a time stays small; behind each one memory is given back."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        trim()


def chunks(texts: list[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive whole texts of about `limit` bytes together."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if held and size + len(b) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield first, held


def shingle_sets(texts: list[str | None], k: int, seed: int = 0) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles; with 1 to k-1 words, the whole sequence is one."""
    coef = mix(np.arange(1, k + 1, dtype=U64) * _MULT + U64(seed)) | U64(1)
    for _, held in chunks(texts):
        sizes = np.fromiter((len(b) + 1 for b in held), np.int64, len(held))
        ends = np.cumsum(sizes)
        starts, words = word_hashes(np.frombuffer(b"\n".join(held) + b"\n", np.uint8))
        cut = np.searchsorted(starts, ends)
        n = len(words)
        if n >= k:
            rolled = words[: n - k + 1] * coef[0]
            for j in range(1, k):
                rolled += words[j : n - k + 1 + j] * coef[j]
            rolled = mix(rolled)
        lo = 0
        for hi in cut.tolist():
            m = hi - lo
            if m >= k:
                yield np.unique(rolled[lo : hi - k + 1])
            elif m:
                short = (words[lo:hi] * coef[:m]).sum(dtype=U64, keepdims=True)
                yield mix((short + U64(m)) ^ U64(0x5851F42D4C957F2D))
            else:
                yield np.zeros(0, U64)
            lo = hi
