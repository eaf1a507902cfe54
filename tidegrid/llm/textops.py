"""Numpy kernels over Arrow string columns: word spans, span hashes and n-grams of whole blocks of texts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are worked on in blocks of about this many bytes, so that memory stays bounded whatever the batch.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


@cache
def _byte_codes() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)


_powers: dict[str, np.ndarray] = {}


def _power(n: int, inverse: bool) -> np.ndarray:
    key = "inverse" if inverse else "power"
    have = _powers.get(key)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        steps = np.full(max(n, BLOCK + BLOCK // 8), U64(base))
        steps[0] = 1
        have = _powers[key] = np.cumprod(steps, dtype=U64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all of them."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_held: list[tuple] = []


def held(key: tuple, make: Callable):
    """What ``make`` gives for ``key``, kept for a worker's next tasks until one asks for another key: one thing at a time."""
    if not _held or _held[0][0] != key:
        _held.clear()
        _held.append((key, make()))
    return _held[0][1]


def release() -> None:
    """Give freed memory back to the system: a worker goes on to other tasks, beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(kernel: Callable) -> Callable:
    """The kernel, followed by ``release``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kernel(batches)
        from tidegrid.llm import textops

        textops.release()

    return run


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole rows with about ``limit`` bytes of text; a longer text gets a block of its own."""
    data, off = text_bytes(batch.column(column))
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def table(word_bytes: str) -> np.ndarray:
    """Look-up of the bytes that belong to words.

    ``spaced``: all but 0x20 and 0x09-0x0D.  ``alnum``: 0-9, a-z and all bytes of non-ASCII characters.
    """
    t = np.ones(256, bool)
    if word_bytes == "spaced":
        t[[0x20, 9, 10, 11, 12, 13]] = False
    else:
        t[:0x30] = t[0x3A:0x61] = t[0x7B:0x80] = False
    return t


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return _LOWER[data]


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  #: n + 1 word indexes at which the texts begin

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), self.counts)


def words(data: np.ndarray, off: np.ndarray, inside_of: np.ndarray) -> Words:
    """Maximal runs of word bytes; a run ends where its text ends."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(off), np.int64))
    inside = inside_of[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    b = off[:-1][off[:-1] < n]
    begins[b] = inside[b]
    e = off[1:][off[1:] > 0] - 1
    ends[e] = inside[e]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(start, end, np.searchsorted(start, off))


def prefix_codes(data: np.ndarray) -> np.ndarray:
    """Running polynomial code: spans are hashed as differences of it."""
    c = np.zeros(len(data) + 1, U64)
    np.cumsum(_byte_codes()[data] * _power(len(data), False)[: len(data)], out=c[1:])
    return c


def span_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    if not len(start):
        return np.zeros(0, U64)
    return mix((codes[end] - codes[start]) * _power(len(codes), True)[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive hashes; the caller drops those that cross texts."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    s = np.full(n, U64(k))
    for j in range(k):
        s = s * U64(0xC6A4A7935BD1E995 | 1) + h[j : j + n]
    return mix(s)


def shingles(h: np.ndarray, first: np.ndarray, k: int, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k-grams of each text in order: hashes, position of their first word, n + 1 offsets by text.

    With ``short``, a text of fewer words, but not none, has one n-gram of all its words.
    """
    counts = np.diff(first)
    s = ngrams(h, k)
    keep = np.zeros(len(h), bool)
    per = np.maximum(counts - k + 1, 0)
    if len(s):
        step = np.zeros(len(h) + 1, np.int64)
        np.add.at(step, first[:-1], (per > 0).astype(np.int64))
        np.add.at(step, first[:-1] + per, -(per > 0).astype(np.int64))
        keep = np.cumsum(step[:-1]) > 0
    out = np.zeros(len(h), U64)
    out[: len(s)] = s
    if short:
        for size in range(1, k):
            at = first[:-1][counts == size]
            if len(at):
                t = np.full(len(at), U64(size))
                for j in range(size):
                    t = t * U64(0xC6A4A7935BD1E995 | 1) + h[at + j]
                out[at], keep[at] = mix(t), True
        per = np.where((counts > 0) & (counts < k), 1, per)
    pos = np.flatnonzero(keep)
    return out[pos], pos, np.concatenate([[0], np.cumsum(per)])


def sort_within(values: np.ndarray, off: np.ndarray) -> None:
    """Sort each text's run of values in place."""
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()


def distinct_within(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text and their offsets."""
    values = values.copy()
    sort_within(values, off)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[off[:-1][off[:-1] < len(values)]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[off]


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of each run."""
    c = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return c[off[1:]] - c[off[:-1]]


def list_array(values: pa.Array | np.ndarray, off: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))


def as_long(h: np.ndarray) -> np.ndarray:
    """Spark has no unsigned long: the same bits as a signed one."""
    return h.view(np.int64)
