"""Language-model scores from subword lattices.

A word's probability is the sum over all its segmentations into pieces of an existing vocabulary; a text's is the product
over its words and the end.  The vocabulary's scores are where the model begins; rounds of expectation maximisation over the
counted words of the training documents fit them to the corpus until it gains no more.  Words are scored by the forward recursion in
log space, over all distinct words of one length at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .common import intermediate, returned, stored, with_row_id, workers_find_package
from .sentencepiece import Vocabulary

U64 = np.uint64
_SLOTS = 18
_SPREAD = U64(0x9E3779B97F4A7C15)
#: Commonest words whose counts are broadcast, 16 bytes each; all others are joined.
BROADCAST_WORDS = 1 << 20
#: Weight of the vocabulary's own probabilities against the corpus's, in pieces.
PRIOR = 1000.0
#: Rounds of expectation maximisation at most, and the gain in log10 for each token below which they end.
ROUNDS, GAIN = 4, 0.003
#: Words of more bytes are scored one by one, position by position; those of up to SHORT bytes can't underflow outside log space.
LONG, SHORT = 256, 40
_CELLS = 1 << 20
#: Words that are worked on together, so that many have the same length.
_WORDS = 1 << 16


class Pieces(NamedTuple):
    """Pieces as byte strings, and log probabilities of them and, last, of the end of a text."""

    texts: tuple[bytes, ...]
    logp: np.ndarray


def prior_pieces(vocabulary: Vocabulary) -> Pieces:
    """Pieces by falling score, and bytes that are no piece and the end with the least piece's.  Probabilities sum to 1."""
    ranked = sorted(vocabulary.pieces, key=lambda p: (-p[2], p[1]))
    texts = [t.encode() for t, _, _ in ranked]
    have = set(texts)
    rest = [b for b in (bytes([i]) for i in range(256)) if b not in have]
    low = ranked[-1][2] if ranked else 0.0
    logp = np.array([score for _, _, score in ranked] + [low] * (len(rest) + 1))
    return Pieces((*texts, *rest), logp - np.log(np.exp(logp).sum()))


class Lattice:
    """Finds the pieces inside words by an open-addressed table of hashes."""

    def __init__(self, pieces: Pieces):
        self.logp, self.longest = pieces.logp, max(map(len, pieces.texts))
        off = np.concatenate([[0], np.cumsum([len(t) for t in pieces.texts])])
        codes = X.prefix_codes(np.frombuffer(b"".join(pieces.texts), np.uint8))
        keys = self._key((codes[off[1:]] - codes[off[:-1]]) * X._power(int(off[-1]) + 1, True)[off[:-1]], np.diff(off).astype(U64))
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces have the same hash")
        self.keys, self.ids = np.zeros(1 << _SLOTS, U64), np.full(1 << _SLOTS, -1, np.int32)
        for i, (key, slot) in enumerate(zip(keys.tolist(), ((keys * _SPREAD) >> U64(64 - _SLOTS)).tolist(), strict=True)):
            while self.ids[slot] >= 0:
                slot = (slot + 1) % (1 << _SLOTS)
            self.keys[slot], self.ids[slot] = key, i
        self.lengths = sorted({len(t) for t in pieces.texts})

    @staticmethod
    def _key(code: np.ndarray, length: np.ndarray) -> np.ndarray:
        return code + length * U64(0xD6E8FEB86659FD93)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = ((keys * _SPREAD) >> U64(64 - _SLOTS)).astype(np.int64)
        ids = self.ids[slot]
        wrong = np.flatnonzero((ids >= 0) & (self.keys[slot] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) % (1 << _SLOTS)
            ids[wrong] = self.ids[slot[wrong]]
            wrong = wrong[(ids[wrong] >= 0) & (self.keys[slot[wrong]] != keys[wrong])]
        return ids

    def _edges(self, chars: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, words, pieces) for all pieces in words of one length, by end and start."""
        n, size = chars.shape
        codes = np.zeros((n, size + 1), U64)
        np.cumsum(X._byte_codes()[chars] * X._power(size, False)[:size], axis=1, out=codes[:, 1:])
        inverse, out = X._power(size, True), []
        for e in range(1, size + 1):
            for length in self.lengths:
                if length > e:
                    break
                s = e - length
                ids = self.find(self._key((codes[:, e] - codes[:, s]) * inverse[s], np.full(1, length, U64)))
                at = np.flatnonzero(ids >= 0)
                if len(at):
                    out.append((s, e, at, ids[at]))
        return out

    def forward(self, chars: np.ndarray, counts: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word (rows of ``chars``); adds to ``expected`` the pieces' expected numbers, ``counts`` times each word."""
        n, size = chars.shape
        edges = self._edges(chars)
        if expected is not None and size <= SHORT:
            p = np.exp(self.logp)
            alpha, beta = np.zeros((size + 1, n)), np.zeros((size + 1, n))
            alpha[0] = beta[size] = 1
            for s, e, at, ids in edges:
                alpha[e, at] += alpha[s, at] * p[ids]
            beta[size] = counts / alpha[size]
            spent = []
            for s, e, at, ids in reversed(edges):
                through = p[ids] * beta[e, at]
                beta[s, at] += through
                spent.append((ids, alpha[s, at] * through))
            ids, weights = (np.concatenate(x) for x in zip(*spent, strict=True))
            expected += np.bincount(ids, weights=weights, minlength=len(expected))
            return np.log(alpha[size])
        alpha = np.full((size + 1, n), -np.inf)
        alpha[0] = 0
        for s, e, at, ids in edges:
            alpha[e, at] = np.logaddexp(alpha[e, at], alpha[s, at] + self.logp[ids])
        if expected is not None:
            beta = np.full((size + 1, n), -np.inf)
            beta[size] = 0
            for s, e, at, ids in reversed(edges):
                through = self.logp[ids] + beta[e, at]
                beta[s, at] = np.logaddexp(beta[s, at], through)
            for s, e, at, ids in edges:
                w = np.exp(alpha[s, at] + self.logp[ids] + beta[e, at] - alpha[size, at]) * counts[at]
                expected += np.bincount(ids, weights=w, minlength=len(expected))
        return alpha[size]

    def long_word(self, word: np.ndarray, count: float = 0.0, expected: np.ndarray | None = None) -> float:
        """``forward`` for one word of any length, in time and memory proportional to it."""
        size = len(word)
        codes, found = X.prefix_codes(word), []
        inverse = X._power(size + 1, True)
        for length in self.lengths:
            for a in range(0, size - length + 1, _CELLS):
                s = np.arange(a, min(a + _CELLS, size - length + 1))
                ids = self.find(self._key((codes[s + length] - codes[s]) * inverse[s], np.full(1, length, U64)))
                at = np.flatnonzero(ids >= 0)
                found.append(np.stack([s[at], s[at] + length, ids[at]]))
        start, end, piece = np.concatenate(found, axis=1)
        order = np.lexsort((start, end))
        start, end, piece = start[order], end[order], piece[order]
        logp = self.logp[piece]
        edges = list(zip(start.tolist(), end.tolist(), logp.tolist(), strict=True))
        alpha = [-np.inf] * (size + 1)
        alpha[0] = 0.0
        for s, e, p in edges:
            x, y = alpha[e], alpha[s] + p
            alpha[e] = y if x == -np.inf else max(x, y) + math.log1p(math.exp(-abs(x - y)))
        if expected is not None:
            beta = [-np.inf] * (size + 1)
            beta[size] = 0.0
            for s, e, p in reversed(edges):
                x, y = beta[s], beta[e] + p
                beta[s] = y if x == -np.inf else max(x, y) + math.log1p(math.exp(-abs(x - y)))
            a, b = np.array(alpha), np.array(beta)
            np.add.at(expected, piece, np.exp(a[start] + logp + b[end] - alpha[size]) * count)
        return alpha[size]

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, counts: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """Log probabilities of words given as spans, a blank before each."""
        size = end - start
        out = np.zeros(len(start))
        order = np.argsort(size, kind="stable")
        bounds = np.flatnonzero(np.diff(size[order], prepend=-1, append=-1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            length = int(size[order[a]])
            if length > LONG:
                for i in order[a:b].tolist():
                    word = np.concatenate([np.full(1, 32, np.uint8), data[start[i] : end[i]]])
                    out[i] = self.long_word(word, 0.0 if counts is None else float(counts[i]), expected)
                continue
            step = max(1, _CELLS // (length + 1) // 4)
            for i in range(a, b, step):
                own = order[i : min(b, i + step)]
                chars = np.full((len(own), length + 1), 32, np.uint8)
                chars[:, 1:] = data[start[own][:, None] + np.arange(length)]
                out[own] = self.forward(chars, None if counts is None else counts[own], expected)
        return out


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, mod 5, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside = X.table("spaced")
    for batch in batches:
        for _, raw, off in X.blocks(batch, "text", 4 << 20):
            data = X.lowered(raw)
            w = X.words(data, off, inside)
            h, at, n = np.unique(X.span_hash(X.prefix_codes(data), w.start, w.end), return_index=True, return_counts=True)
            flat = data.tobytes()
            text = [flat[a:b].decode(errors="replace") for a, b in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(X.as_long(h)), pa.array(text, pa.string()), pa.array(n.astype(np.int64))], names=["hash", "word", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """(hash, word, n): how often the training documents hold each word, summed in blocks before the shuffle."""
    rows = docs.where(~held_out(F.col("doc_id"))).select(F.col("text").cast("string").alias("text")).where("text is not null")
    workers_find_package(docs.sparkSession)
    return rows.mapInArrow(X.tidy(_count_words), "hash bigint, word string, n bigint").groupBy("hash", "word").agg(F.sum("n").alias("n"))


def _expect(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(pieces.value)
        expected = np.zeros(len(pieces.value.texts) + 1)

        def take(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            data, off = X.text_bytes(table.column("word").chunk(0))
            n = table.column("n").to_numpy().astype(float)
            expected[-1] += (lattice.words(data, off[:-1], off[1:], n, expected[:-1]) * n).sum()

        held, rows = [], 0
        for batch in batches:
            held, rows = [*held, batch], rows + batch.num_rows
            if rows >= _WORDS:
                take(held)
                held, rows = [], 0
        if rows:
            take(held)
        at = np.flatnonzero(expected)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(expected[at])], names=["piece", "expected"])

    return run


def fit_pieces(words: DataFrame, prior: Pieces, documents: int) -> Pieces:
    """Expectation maximisation over all counted words; in each round the driver gets a row for each piece and the log probability."""
    spark = words.sparkSession
    tokens = (words.agg(F.sum("n")).first()[0] or 0) + documents
    now, before = prior, -np.inf
    for _ in range(ROUNDS if tokens else 0):
        b = spark.sparkContext.broadcast(now)
        got = words.select("word", "n").mapInArrow(X.tidy(_expect(b)), "piece int, expected double").groupBy("piece").agg(F.sum("expected").alias("expected")).collect()
        n = PRIOR * np.exp(prior.logp)
        reached = documents * now.logp[-1]
        for r in got:
            if r["piece"] < len(prior.texts):
                n[r["piece"]] += r["expected"]
            else:
                reached += r["expected"]
        n[-1] += documents
        now = Pieces(prior.texts, np.log(n / n.sum()))
        b.unpersist()
        if reached - before < GAIN * tokens * np.log(10):
            break
        before = reached
    return now


def _lattice(pieces: Pieces) -> Lattice:
    return X.held(("lattice", hash(pieces.logp.tobytes())), lambda: Lattice(pieces))


def _score(pieces, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, (hashes, counts) = pieces.value, common.value
        hashes, counts = np.frombuffer(hashes, U64), np.frombuffer(counts, np.int64)
        lattice, inside = _lattice(p), X.table("spaced")
        for batch in batches:
            for part, raw, off in X.blocks(batch, "text", 4 << 20):
                data = X.lowered(raw)
                w = X.words(data, off, inside)
                h, at, which = np.unique(X.span_hash(X.prefix_codes(data), w.start, w.end), return_index=True, return_inverse=True)
                logp = lattice.words(data, w.start[at], w.end[at])
                slot = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
                there = hashes[slot] == h if len(hashes) else np.zeros(len(h), bool)
                c = np.where(there, counts[slot], 0) if len(hashes) else np.zeros(len(h), np.int64)
                base = np.where(there, np.log10(c + 0.5), 0.0)
                rest = ~there[which]
                pos = np.flatnonzero(rest)
                cuts = np.searchsorted(pos, w.first)
                cols = [
                    part.column("uid"), part.column("doc_id"), pa.array(w.counts + 1), pa.array(X.sums(there[which].astype(np.int64), w.first)),
                    pa.array(X.sums(base[which], w.first)), pa.array((X.sums(logp[which], w.first) + p.logp[-1]) / np.log(10)), X.list_array(X.as_long(h[which[pos]]), cuts),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["uid", "doc_id", "n_tokens", "n_common", "base_common", "score", "others"])

    return run


def score(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document: uid, doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Words are runs of all but 0x20 and 0x09-0x0D, A-Z in lower case; the end is a token too, so an empty or null text has one.
    ``base_score`` is the add-half unigram of the contract, from all training documents; ``score`` the lattice model's.
    Rows that repeat are learned from and scored each; a null doc_id is not held out.  Without training documents all counts
    are 0 and the pieces keep the vocabulary's probabilities.  Only doc_id and text are read.  The result is a stored table.
    """
    workers_find_package(docs.sparkSession)
    with intermediate(docs.sparkSession):
        return returned(_scored(docs, vocabulary), "lm-scores")


def _scored(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    words = stored(count_words(rows), "words")
    total = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    documents = rows.where(~held_out(F.col("doc_id"))).count()
    n, v = (total["n"] or 0) + documents, total["v"] + (documents > 0)
    # the least count, on a scale of eighths of powers of two, of which BROADCAST_WORDS or fewer words have as much or more
    step = F.floor(F.log2("n") * 8)
    least, have = 512, 0
    for r in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # 512 rows at most
        have += r["count"]
        if have > BROADCAST_WORDS:
            break
        least = r["step"]
    common = words.where(step >= least).select("hash", "n").toArrow()
    hashes, counts = (common.column(i).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    order = np.argsort(hashes.view(U64))
    common = spark.sparkContext.broadcast((hashes[order].tobytes(), counts[order].tobytes()))
    pieces = fit_pieces(words, prior_pieces(vocabulary), documents)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = with_row_id(rows).mapInArrow(
        X.tidy(_score(spark.sparkContext.broadcast(pieces), common)), f"uid bigint, doc_id {kind}, n_tokens bigint, n_common bigint, base_common double, score double, others array<bigint>"
    )
    scored = stored(scored, "scored")
    others = scored.select("uid", F.explode("others").alias("hash")).groupBy("uid", "hash").agg(F.count(F.lit(1)).alias("times"))
    counted = others.join(words.where(step < least).select("hash", "n"), "hash", "left").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("base_rest"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_rest")
    )
    rate = float(np.log10(n + 0.5 * (v + 1)))
    end = float(np.log10(documents + 0.5))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return scored.join(counted, "uid", "left").select(
        "uid", "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_common") + zero("known_rest") + int(documents > 0)).cast("bigint").alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base_common") + zero("base_rest") + end - F.col("n_tokens") * rate).alias("base_score"), "score",
    )
