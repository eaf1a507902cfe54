"""Removal of byte strings that documents share, by sparse suffix sorting.

Every 50-byte window has a key, the least hash of the 24-byte strings inside it.  Equal windows have equal keys, and a key
stays the same over a run of windows, so keys are few.  Keys that only one document has are found first; only runs with a key
that documents share are sent, with their bytes, to the key's part.  There the suffixes that begin at their windows are
sorted deep-shallow: multikey quicksort on eight-byte words down to a shallow depth, then blind tries for groups that
still share a prefix, whose nodes know only the byte at which their windows part.  Leaves are equal windows, of which all but
those of the least doc_id are covered.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .common import partitions_for, require_integer, stored, workers_find_package

U64 = np.uint64
WIDTH, GRAM = 50, 24
SHALLOW = 16
#: Bytes of a key that are sent; its part, which follows from other bits, adds to them.
_KEY_BYTES = 6
#: Bytes of text in a block.
_BLOCK = 2 << 20
_LAST = np.iinfo(np.int64).max


#: Runs of so few windows are sorted directly, as multikey quicksort does with its smallest parts.
_SMALL = 1 << 15


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as numbers that sort as the bytes do."""
    return np.ndarray((len(data) + 1,), ">u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def multikey_quicksort(data: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows sorted by their first ``depth`` bytes: indexes into ``start``, and whether each differs there from the one before.

    A part is split by a pivot's eight bytes into those below, equal and above; only the equal ones go eight bytes deeper.
    """
    words = _words(data)
    order, news = [], []
    at_depth = lambda own, at: words[start[own] + at].astype(U64)
    parts = [(np.arange(len(start)), 0, at_depth(np.arange(len(start)), 0))] if len(start) else []
    while parts:
        own, at, w = parts.pop()
        if len(own) > _SMALL and at < depth:
            pivot = np.sort(w[:: len(w) // 15])[7]
            below, above = np.flatnonzero(w < pivot), np.flatnonzero(w > pivot)
            equal = np.flatnonzero(w == pivot)
            if len(above):
                parts.append((own[above], at, w[above]))
            parts.append((own[equal], at + 8, at_depth(own[equal], at + 8) if at + 8 < depth else w[:0]))
            if len(below):
                parts.append((own[below], at, w[below]))
            continue
        new = np.zeros(len(own), bool)
        new[0] = True
        if at < depth:
            by = np.argsort(w)
            own, w = own[by], w[by]
            new[1:] = w[1:] != w[:-1]
            for k in range(at + 8, depth, 8):  # only those that still agree
                tied = np.flatnonzero(~(new & np.append(new[1:], True)))
                w, group = at_depth(own[tied], k), np.cumsum(new)[tied]
                by = np.lexsort((w, group))
                own[tied], w = own[tied[by]], w[by]
                new[tied[1:]] |= w[1:] != w[:-1]
        order.append(own)
        news.append(new)
    if not order:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(order), np.concatenate(news)


class Tries(NamedTuple):
    """Blind tries of several groups in arrays.  Node i holds ``order[first[i] : first[i] + size[i]]``, whose windows agree up to
    byte ``depth[i]`` and part there; -1 marks a leaf of equal windows.  ``edge`` is the byte that leads to it from ``parent``;
    the bytes between are skipped, and not kept."""

    order: np.ndarray
    first: np.ndarray
    size: np.ndarray
    depth: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def _parting(words: np.ndarray, start: np.ndarray, group: np.ndarray, first: np.ndarray, below: int) -> np.ndarray:
    """The byte from ``below`` on at which each group's windows first differ from one of them, or -1."""
    depth = np.full(len(first), WIDTH, np.int64)
    alive = np.arange(len(start))
    for at in range(below, WIDTH, 8):
        place = min(at, WIDTH - 8)
        w = words[start[alive] + place].astype(U64)
        differs = w ^ words[start[first[group[alive]]] + place].astype(U64)
        one = np.flatnonzero(differs)
        if len(one):
            # the highest bit that differs: its byte
            byte = 7 - (np.frexp(differs[one].astype(np.float64))[1] - 1) // 8
            # rounding up to the next power of two can name the byte before
            byte = np.where((differs[one] >> ((7 - np.maximum(byte, 0)) * 8).astype(U64)) == 0, byte + 1, byte)
            np.minimum.at(depth, group[alive[one]], place + byte)
        alive = alive[depth[group[alive]] == WIDTH]
        if not len(alive):
            break
    depth[depth == WIDTH] = -1
    return depth


def blind_tries(data: np.ndarray, start: np.ndarray, order: np.ndarray, new: np.ndarray) -> Tries:
    """A blind trie for each group of windows that agree in their first SHALLOW bytes, all grown level by level.

    A node's depth is the first byte at which its windows part; only that byte is looked at to deal them to its children.
    """
    words, order = _words(data), order.copy()
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    level = (first, size, np.full(len(first), -1), np.full(len(first), -1))
    nodes: list[tuple] = []
    count = 0
    while len(level[0]):
        first, size, parent, edge = level
        member = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        group = np.repeat(np.arange(len(first)), size)
        depth = np.full(len(first), -1, np.int64)
        several = size > 1
        if several.any():
            own = several[group]
            number = np.cumsum(several) - 1
            lead = np.cumsum(size[several]) - size[several]
            depth[several] = _parting(words, start[order[member[own]]], number[group[own]], lead, SHALLOW)
        nodes.append((first, size, depth, parent, edge))
        parts = (depth >= 0)[group]
        member, group = member[parts], group[parts]
        byte = data[start[order[member]] + depth[group]] if len(member) else np.zeros(0, np.uint8)
        by = np.lexsort((byte, group))
        order[member] = order[member[by]]
        byte = byte[by]
        begins = np.ones(len(member), bool)
        begins[1:] = (group[1:] != group[:-1]) | (byte[1:] != byte[:-1])
        at = np.flatnonzero(begins)
        level = (member[at], np.diff(np.append(at, len(member))), group[at] + count, byte[at].astype(np.int64))
        count += len(first)
    return Tries(order, *(np.concatenate(x) if nodes else np.zeros(0, np.int64) for x in zip(*nodes, strict=True))) if nodes else Tries(order, *[np.zeros(0, np.int64)] * 5)


def equal_windows(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the WIDTH-byte windows that have equals, sorted, as (index into ``start``, whether a new group begins).

    Deep-shallow: multikey quicksort to SHALLOW bytes, then blind tries for the groups that still agree.
    """
    order, new = multikey_quicksort(data, start, SHALLOW)
    single = new & np.append(new[1:], True) if len(new) else new
    order, new = order[~single], new[~single]
    trie = blind_tries(data, start, order, new)
    leaf = (trie.depth < 0) & (trie.size > 1)
    first, size = trie.first[leaf], trie.size[leaf]
    by = np.argsort(first)
    first, size = first[by], size[by]
    begins = np.zeros(int(size.sum()), bool)
    begins[np.cumsum(size) - size] = True
    return trie.order[np.arange(len(begins)) + np.repeat(first - (np.cumsum(size) - size), size)], begins


#: Windows that are sorted at a time; equal ones fall into the same share.
_SORTED = 1 << 18


def covered_windows(data: np.ndarray, start: np.ndarray, doc: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each window also begins in a document with a smaller id; window i belongs to document ``doc[of[i]]``.

    Windows are dealt by a hash of their first eight bytes into shares of bounded size, which are sorted one by one.
    """
    out = np.zeros(len(start), bool)
    shares = -(-len(start) // _SORTED)
    if shares > 1:
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        share = np.empty(len(start), np.int16)
        for i in range(0, len(start), _SORTED):
            share[i : i + _SORTED] = X.mix(words[start[i : i + _SORTED]].astype(U64)) % U64(shares)
    for k in range(shares):
        own = np.flatnonzero(share == k) if shares > 1 else np.arange(len(start))
        order, new = equal_windows(data, start[own])
        if len(order):
            order = own[order]
            d = doc[of[order]]
            least = np.minimum.reduceat(d, np.flatnonzero(new))[np.cumsum(new) - 1]
            out[order] = d > least
    return out


def runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one text with one key: first window, number of windows, text, key."""
    n = len(data)
    if n < WIDTH:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(U64)
    codes = X.prefix_codes(data)
    h = (codes[GRAM:] - codes[:-GRAM]) * X._power(n, True)[: n - GRAM + 1]
    h ^= h >> U64(32)
    h *= U64(0x9FB21C651E98DF25)
    h ^= h >> U64(29)
    least, have = h, 1
    span = WIDTH - GRAM + 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    valid = np.zeros(len(least) + 1, np.int64)
    fits = np.diff(off) >= WIDTH
    np.add.at(valid, off[:-1][fits], 1)
    np.add.at(valid, off[1:][fits] - WIDTH + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    begin_of = off[:-1][fits]
    new[begin_of] = True
    begin = np.flatnonzero(new)
    ends = np.flatnonzero(np.append(~valid, True))
    stop = np.minimum(np.append(begin[1:], len(least)), ends[np.searchsorted(ends, begin)])
    return begin, stop - begin, np.searchsorted(off, begin, side="right") - 1, least[begin]


class _Keys:
    """A block's keys: those that several of its documents have, and those of one, in the order they are sent."""

    def __init__(self, doc: np.ndarray, key: np.ndarray, parts: int):
        self.part = ((X.mix(key) & U64(0xFFFFFFFF)) * U64(parts) >> U64(32)).astype(np.int64)
        order = np.lexsort((doc, key))
        k, d = key[order], doc[order]
        first = np.diff(k, prepend=~k[:1]) != 0
        group = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        many = (np.maximum.reduceat(d, at) != np.minimum.reduceat(d, at)) if len(at) else np.zeros(0, bool)
        self.shared = np.zeros(len(key), bool)
        self.shared[order] = many[group]
        once = order[first]  # one run for each key
        by = once[np.lexsort((key[once], self.part[once]))]
        self.marks, self.sent = by[self.shared[by]], by[~self.shared[by]]
        self.key = key

    def matched(self, bits: np.ndarray) -> np.ndarray:
        """Runs whose key other documents have, given the answers for the keys sent."""
        keys = np.sort(self.key[self.sent[bits]])
        if not len(keys):
            return self.shared
        slot = np.minimum(np.searchsorted(keys, self.key), len(keys) - 1)
        return self.shared | (keys[slot] == self.key)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze, n, task = zstandard.ZstdCompressor(level=3), 0, TaskContext.get().partitionId()
    for batch in batches:
        for part, raw, off in X.blocks(batch, "text", _BLOCK):
            ids = part.column("doc_id").fill_null(_LAST).to_numpy()
            null = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            row = ((task << 32) + n, ids.tobytes(), np.packbits(null).tobytes(), off.tobytes(), squeeze.compress(raw.tobytes()))
            n += 1
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), *[pa.binary()] * 4), strict=True)], names=["block", "ids", "nulls", "offsets", "data"])


def _unpacked(batch: pa.RecordBatch, i: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    get = lambda name: batch.column(name)[i].as_py()
    ids, off = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("offsets"), np.int64)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(get("data"), max_output_size=max(1, int(off[-1]))), np.uint8)
    return get("block"), ids, np.unpackbits(np.frombuffer(get("nulls"), np.uint8))[: len(ids)].astype(bool), off, raw


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=names)


def _short(keys: np.ndarray) -> bytes:
    return (keys >> U64(64 - 8 * _KEY_BYTES)).view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _KEY_BYTES, 8), np.uint8)
    out[:, :_KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _KEY_BYTES)
    return out.view(U64).ravel()


def _send_keys(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, ids, _, off, raw = _unpacked(batch, i)
                _, _, text, key = runs(raw, off)
                k = _Keys(ids[text], key, parts)
                rows = []
                for p, sent, marks in zip(range(parts), np.split(k.sent, np.searchsorted(k.part[k.sent], np.arange(1, parts))), np.split(k.marks, np.searchsorted(k.part[k.marks], np.arange(1, parts))), strict=True):
                    if len(sent) or len(marks):
                        rows.append((p, block, _short(key[sent]), _short(key[marks])))
                yield _rows(rows, ["part", "block", "sent", "marks"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    return run


def _answer_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block's keys, a bit whether another block or several documents of one have the key."""
    heads, keys, marks = [], [], []
    for batch in batches:
        for i in range(batch.num_rows):
            k = _long(batch.column("sent")[i].as_py())
            p = U64(batch.column("part")[i].as_py())
            heads.append((batch.column("block")[i].as_py(), int(p), len(k)))
            # the part in the two highest bytes: several parts may meet in a task
            keys.append(k ^ (p << U64(48)))
            marks.append(_long(batch.column("marks")[i].as_py()) ^ (p << U64(48)))
    if not heads:
        return
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.diff(k, prepend=~k[:1]) != 0
    many = np.bincount(np.cumsum(first) - 1) > 1 if len(k) else np.zeros(0, bool)
    known = np.sort(np.concatenate(marks))
    hit = np.zeros(len(key), bool)
    hit[order] = many[np.cumsum(first) - 1]
    if len(known) and len(key):
        slot = np.minimum(np.searchsorted(known, key), len(known) - 1)
        hit |= known[slot] == key
    cut = np.concatenate([[0], np.cumsum([h[2] for h in heads])])
    rows = [(block, p, np.packbits(hit[a:b]).tobytes(), n) for (block, p, n), a, b in zip(heads, cut[:-1], cut[1:], strict=True) if hit[a:b].any()]
    yield _rows(rows, ["block", "part", "bits", "n"], [pa.int64(), pa.int32(), pa.binary(), pa.int32()])


def _window_spans(start: np.ndarray) -> np.ndarray:
    """Byte spans that windows at sorted places cover, as rows of (begin, end)."""
    if not len(start):
        return np.zeros((0, 2), np.int32)
    new = np.flatnonzero(np.diff(start, prepend=-2) != 1)
    return np.stack([start[new], start[np.append(new[1:], len(start)) - 1] + WIDTH], axis=1).astype(np.int32)


def _windows_of(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run and place of each window of runs."""
    run_ = np.repeat(np.arange(len(size), dtype=np.int32), size)
    return run_, np.arange(len(run_), dtype=np.int32) + np.repeat((begin - (np.cumsum(size) - size)).astype(np.int32), size)


_CONTEXT = ["part", "block", "spans", "docs", "starts", "sizes", "data"]
_CONTEXT_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def _send_contexts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for i in range(batch.num_rows):
                block, ids, _, off, raw = _unpacked(batch, i)
                begin, size, text, key = runs(raw, off)
                k = _Keys(ids[text], key, parts)
                bits = np.zeros(len(k.sent), bool)
                cut = np.searchsorted(k.part[k.sent], np.arange(parts + 1))
                for a in batch.column("answers")[i].as_py() or ():
                    bits[cut[a["part"]] : cut[a["part"] + 1]] = np.unpackbits(np.frombuffer(a["bits"], np.uint8))[: a["n"]].astype(bool)
                own = np.flatnonzero(k.matched(bits))
                # what a smaller document of this block covers is settled here
                run_, at = _windows_of(begin[own], size[own])
                settled = covered_windows(raw, at, ids[text[own]], run_)
                rows = [(block % parts, block, _window_spans(at[settled]).tobytes(), b"", b"", b"", b"")]
                own = own[np.bincount(run_, weights=~settled, minlength=len(own)) > 0]
                own = own[np.argsort(k.part[own], kind="stable")]
                for p, mine in zip(range(parts), np.split(own, np.searchsorted(k.part[own], np.arange(1, parts))), strict=True):
                    if len(mine):
                        length = size[mine] + WIDTH - 1
                        index = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begin[mine], length)
                        rows.append((p, block, b"", ids[text[mine]].tobytes(), begin[mine].astype(np.int32).tobytes(), size[mine].astype(np.int32).tobytes(), squeeze.compress(raw[index].tobytes())))
                yield _rows(rows, _CONTEXT, _CONTEXT_TYPES)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each block that smaller documents of other blocks cover, part by part; those settled before are passed on."""
    held: list[tuple] = []
    at = None
    for batch in batches:
        passed = []
        for i in range(batch.num_rows):
            get = lambda name, i=i, batch=batch: batch.column(name)[i].as_py()
            if get("part") != at:
                yield from _settled(held)
                held, at = [], get("part")
            if spans := get("spans"):
                passed.append((get("block"), spans))
            if docs := get("docs"):
                held.append((get("block"), docs, get("starts"), get("sizes"), get("data")))
        yield _rows(passed, ["block", "spans"], [pa.int64(), pa.binary()])
    yield from _settled(held)


def _settled(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """One part's contexts, (block, docs, starts, sizes, data) from each block that has some."""
    if not held:
        return
    docs = [np.frombuffer(h[1], np.int64) for h in held]
    block = np.repeat(np.array([h[0] for h in held]), [len(d) for d in docs])
    doc = np.concatenate(docs)
    start, size = (np.concatenate([np.frombuffer(h[i], np.int32) for h in held]).astype(np.int64) for i in (2, 3))
    length = size + WIDTH - 1
    place = np.cumsum(length) - length
    text = np.empty(int(length.sum()), np.uint8)
    filled = 0
    for h in held:
        piece = zstandard.ZstdDecompressor().decompress(h[4], max_output_size=len(text) - filled)
        text[filled : filled + len(piece)] = np.frombuffer(piece, np.uint8)
        filled += len(piece)
    run_, at = _windows_of(place, size)
    hit = np.flatnonzero(covered_windows(text, at, doc, run_))
    run_, at = run_[hit], at[hit]
    at = start[run_] + at - place[run_]
    order = np.lexsort((at, block[run_]))
    at, own = at[order], block[run_][order]
    cut = np.flatnonzero(np.diff(own, prepend=own[:1] - 1)) if len(own) else np.zeros(0, np.int64)
    rows = [(int(own[a]), _window_spans(at[a:b]).tobytes()) for a, b in zip(cut, np.append(cut, len(own))[1:], strict=True)]
    yield _rows(rows, ["block", "spans"], [pa.int64(), pa.binary()])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            _, ids, null, off, raw = _unpacked(batch, i)
            step = np.zeros(len(raw) + 1, np.int64)
            for s in batch.column("found")[i].as_py() or ():
                spans = np.frombuffer(s, np.int32).reshape(-1, 2)
                np.add.at(step, spans[:, 0], 1)
                np.add.at(step, spans[:, 1], -1)
            gone = np.cumsum(step[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            b = off[:-1][off[:-1] < len(raw)]
            begins[b] = gone[b]
            ends = gone.copy()
            ends[:-1] &= ~gone[1:]
            e = off[1:][off[1:] > 0] - 1
            ends[e] = gone[e]
            first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            cut = np.searchsorted(first, off)
            kept = raw[~gone].tobytes()
            at = np.concatenate([[0], np.cumsum(~gone)])[off].tolist()
            rest = [kept[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            doc = np.searchsorted(off, first, side="right") - 1
            local = pa.StructArray.from_arrays([pa.array(first - off[doc]), pa.array(last - off[doc])], names=["start", "stop"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=null), pa.array(np.diff(off)), pa.array(X.sums(gone.astype(np.int64), off)), X.list_array(local, cut), pa.array(rest, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "removed", "kept"],
            )


def remove_shared(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, removed (byte spans, the maximal runs taken out) and kept (the other bytes).

    A byte goes if a 50-byte string over it also begins in a document with a smaller doc_id; matches never cross documents
    and are judged on the texts as they come.  A null text is empty.  Rows of one doc_id are one document in this: they don't
    remove from each other, and each gets a row; null doc_ids are larger than all others.  ``doc_id`` is an integer, else an
    error; only it and text are read.  A block is two megabytes of text or one longer text.
    """
    require_integer(docs)
    workers_find_package(docs.sparkSession)
    parts = partitions_for(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = stored(rows.mapInArrow(X.tidy(_pack), "block bigint, ids binary, nulls binary, offsets binary, data binary"), "packed")
    sent = packed.mapInArrow(X.tidy(_send_keys(parts)), "part int, block bigint, sent binary, marks binary").repartition(parts, "part")
    answers = sent.mapInArrow(X.tidy(_answer_keys), "block bigint, part int, bits binary, n int").groupBy("block").agg(F.collect_list(F.struct("part", "bits", "n")).alias("answers"))
    contexts = packed.join(answers, "block", "left").mapInArrow(X.tidy(_send_contexts(parts)), "part int, block bigint, spans binary, docs binary, starts binary, sizes binary, data binary").repartition(parts, "part").sortWithinPartitions("part")
    found = contexts.mapInArrow(X.tidy(_settle), "block bigint, spans binary").groupBy("block").agg(F.collect_list("spans").alias("found"))
    return packed.join(found, "block", "left").mapInArrow(X.tidy(_apply), "doc_id bigint, n_bytes bigint, n_removed bigint, removed array<struct<start:bigint,stop:bigint>>, kept binary")
