"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built for each language.  A text is parsed greedily into the longest phrases that
occur in that labelled text; the more alike the languages, the longer and fewer the phrases.  The count of phrases,
normalised to bits for each byte, is the cross-parsing entropy: the language with the least wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from . import textops as X
from .common import with_kernel, workers_find_package

#: Bounds of the labelled sample: so many rows of a language and so many characters of each.  All languages together have
#: SAMPLE characters at most: with many of them, each has an equal share, and none is left out.
ROWS, ROW_CHARS, SAMPLE = 128, 128, 1 << 18
#: Texts are laid out in pieces of so many bytes, so that short and long texts fill the same array; a parse runs on through them.
PIECE = 256
UNKNOWN = "und"
#: A text is foreign if in each language it takes so many times that language's own bits a byte, and
#: SLACK bits more, which short texts need.  By measure: see the README.
FOREIGN, SLACK = 2.0, 200.0


class Reference(NamedTuple):
    lang: str
    text: bytes  #: labelled text in lower case, letters and single blanks
    rate: float = float("inf")  #: bits a byte of other labelled text of the language, its third quartile; no bound if there is too little


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes as the parser sees them: lower case, and every byte of ASCII that is no letter as a blank."""
    t = np.full(256, 32, np.uint8)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t[data]


def _squeezed(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of blanks as one; none at the start of a text."""
    f = folded(data)
    keep = f != 32
    keep[1:] |= f[:-1] != 32
    b = off[:-1][off[:-1] < len(f)]
    keep[b] = f[b] != 32
    return f[keep], np.concatenate([[0], np.cumsum(keep)])[off]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions by state; every path from state 0 spells a substring of ``text`` and each substring has its path."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur, p = len(go), last
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return go


class Parser:
    """All languages' automata in one table.

    An entry holds the next state times the width and, in its two lowest bits, how many phrases end: the one before the
    byte, and the byte itself if it occurs nowhere in the labelled text.  Padding keeps the state.
    """

    def __init__(self, references: list[Reference]):
        seen = sorted({c for r in references for c in r.text})
        self.classes = np.full(256, len(seen), np.int64)
        self.classes[seen] = np.arange(len(seen))
        self.width = len(seen) + 2
        tables, base = [], 0
        self.roots, self.bits = [], np.array([np.log2(max(2, len(r.text))) for r in references])
        for r in references:
            go = suffix_automaton(r.text)
            root = np.zeros(self.width, np.int64)
            for c, to in go[0].items():
                root[self.classes[c]] = to
            unknown = np.ones(self.width, bool)
            unknown[[self.classes[c] for c in go[0]]] = False
            t = np.tile(root * 4 + 1 + unknown, (len(go), 1))
            rows, cols, to = zip(*((s, self.classes[c], v) for s, e in enumerate(go) for c, v in e.items()), strict=True) if len(go) > 1 else ((), (), ())
            t[list(rows), list(cols)] = np.array(to, np.int64) * 4
            t[0, unknown] = 1
            t[:, -1] = np.arange(len(go)) * 4
            ended = (t & 3).astype(np.int8)
            t >>= 2
            t += base
            t *= self.width * 4
            t += ended
            tables.append(t.astype(np.int32) if (base + len(go)) * self.width * 4 < 2**31 else t)
            self.roots.append(base * self.width)
            base += len(go)
        self.table = np.concatenate(tables).astype(np.int32 if base * self.width * 4 < 2**31 else np.int64).ravel()

    def _steps(self, state: np.ndarray, grid: np.ndarray, left: np.ndarray, states: np.ndarray, ended: np.ndarray, meet: bool) -> np.ndarray:
        """Parse columns of ``grid`` from ``state``, keep states and ended phrases of each step; columns are sorted by falling ``left``.

        With ``meet``, a column stops where it reaches the state that it had there before: from there on all is as it was.
        Returns whether a column ran to its end.
        """
        own, ran = np.arange(len(left)), np.zeros(len(left), bool)
        for t in range(int(left.max(initial=0))):
            live = own[left[own] > t] if meet else own[: np.searchsorted(-left, -t, side="left")]
            ran[own[left[own] == t]] = True
            own = live
            if not len(own):
                break
            v = self.table[state[own] + grid[t, own]]
            now = v >> 2
            ended[t, own] = v & 3
            state[own] = now
            if meet:
                same = states[t, own] == now
                states[t, own] = now
                own = own[~same]
            else:
                states[t, own] = now
        ran[own] = True
        return ran

    def phrases(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language's parse, an array of (languages, texts).

        All pieces are parsed at once as if a text began there.  Then each goes on from where the one before really ended, until
        both parses meet, again and again until no end changes: the result is the parse of the whole text.
        """
        cls = self.classes[data].astype(np.int32)
        sizes = np.diff(off)
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = off[:-1][owner] + number * PIECE
        left = np.minimum(off[1:][owner] - begin, PIECE)
        order = np.argsort(-left, kind="stable")
        column = np.empty(len(order), np.int64)  # of each piece
        column[order] = np.arange(len(order))
        left = left[order]
        grid = np.full((PIECE, len(owner)), self.width - 1, np.int32)
        for t in range(int(left.max(initial=0))):
            n = np.searchsorted(-left, -t, side="left")
            grid[t, :n] = cls[begin[order[:n]] + t]
        last = np.cumsum(pieces)[pieces > 0] - 1  # the piece that ends each text
        counts = np.zeros((len(self.roots), len(sizes)), np.int64)
        if not len(owner):
            return counts
        states = np.empty((PIECE, len(owner)), self.table.dtype)
        ended = np.zeros((PIECE, len(owner)), np.int8)
        for i, root in enumerate(self.roots):
            ended[:] = 0
            self._steps(np.full(len(owner), root, self.table.dtype), grid, left, states, ended, False)
            todo = np.flatnonzero(number > 0)
            while len(todo):
                todo = todo[np.argsort(-left[column[todo]], kind="stable")]
                own, before = column[todo], column[todo - 1]
                state = states[left[before] - 1, before].copy()
                part, done = states[:, own], ended[:, own]
                ran = self._steps(state, grid[:, own], left[own], part, done, True)
                changed = ran & (part[left[own] - 1, np.arange(len(own))] != states[left[own] - 1, own])
                states[:, own], ended[:, own] = part, done
                todo = todo[changed] + 1
                todo = todo[todo < len(number)]
                todo = todo[number[todo] > 0]
            by_piece = ended.sum(axis=0, dtype=np.int64)[column]
            # the phrase that a text ends in; the root means that none has begun
            by_piece[last] += states[left[column[last]] - 1, column[last]] != root
            counts[i] = X.sums(by_piece, np.concatenate([[0], np.cumsum(pieces)]))
        return counts


def _parser(references: list[Reference]) -> Parser | None:
    return X.held(("languages", hash(tuple(references))), lambda: Parser(references)) if references else None


def _scorer(references, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = references.value
        parser = _parser(refs)
        langs, own = np.array([r.lang for r in refs] or [UNKNOWN], object), np.array([r.rate for r in refs] or [np.inf])
        for batch in batches:
            for part, raw, off in X.blocks(batch, column):
                n = len(off) - 1
                lang, score, rate, foreign = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n), np.zeros(n, bool)
                if parser is not None:
                    data, cut = _squeezed(raw, off)
                    size = np.diff(cut)
                    bits = parser.phrases(data, cut) * parser.bits[:, None] / np.maximum(1, size)
                    best = bits.argmin(axis=0)
                    inverse = 1 / np.maximum(bits, 1e-9) ** 8
                    known = size > 0
                    lang[known] = langs[best[known]]
                    score[known] = (inverse.max(axis=0) / inverse.sum(axis=0))[known]
                    rate = bits.min(axis=0)
                    foreign = known & (bits * size > FOREIGN * np.minimum(own, 1e9)[:, None] * size + SLACK).all(axis=0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rate), pa.array(foreign)], names=[*part.schema.names, "__lang", "__score", "__bits", "__foreign"])

    return run


def held_out(doc_id: Column) -> Column:
    """Documents that no language's text is taken from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame) -> list[Reference]:
    """Labelled text of each language from rows with text and lang that are not held out.

    Of each language, two times ROWS rows at most come to the driver, ROW_CHARS characters of each: those with the smallest
    hash of doc_id and text, rows that are equal in both counted once, so that the sample follows from the rows alone, however they
    lie in files and partitions.  The first half is learned from, with the second the language's own bits a byte are measured.  SAMPLE bounds
    the characters of all languages; their number doesn't grow with the documents, and neither do the automata.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id"), text.alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    rows = rows.withColumn("order", F.xxhash64("doc_id", "text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("order").alias("n")).collect()}
    if not counts:
        return []
    share = max(1, SAMPLE // len(counts))
    chars = min(ROW_CHARS, share)
    wanted = max(1, min(ROWS, share // chars))
    # a fraction that leaves about four times as many rows as are wanted, then the smallest hashes of those
    part = F.element_at(F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, 8.0 * wanted / max(1, n) + 1e-9))]), F.col("lang"))
    picked = rows.withColumn("share", part).where((F.col("share") >= 1) | ((F.shiftrightunsigned("order", 11) / F.lit(float(1 << 53))) < F.col("share")))
    picked = picked.groupBy("lang", "order").agg(F.min(F.expr(f"substring(text, cast(floor(length(text) * pmod(order, 1000) / 1250) as int) + 1, {chars})")).alias("part"))
    picked = picked.select("lang", F.struct("order", "part").alias("x"))
    chosen = picked.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list("x")), 1, 2 * wanted).alias("xs")).orderBy("lang").collect()
    learned, others = {}, {}
    for r in chosen:
        parts = [x["part"] for x in r["xs"]]
        half = -(-len(parts) // 2)
        for kind, texts in ((learned, parts[:half]), (others, parts[half:])):
            raw = np.frombuffer(" ".join(texts).encode(), np.uint8)
            data, _ = _squeezed(raw, np.array([0, len(raw)]))
            if len(data):
                kind[r["lang"]] = data
    out = []
    for lang, data in learned.items():
        ref = Reference(lang, data.tobytes())
        other = others.get(lang, data[:0])
        cut = np.append(np.arange(0, len(other), 2 * chars), len(other))
        if len(cut) > 4:
            own = Parser([ref])
            ref = ref._replace(rate=float(np.quantile(own.phrases(other, cut)[0] * own.bits[0] / np.maximum(1, np.diff(cut)), 0.75)))
        out.append(ref)
    return out


def tagged(docs: DataFrame, references: list[Reference], lang: str = "lang_pred", score: str = "score", bits: str = "bits", foreign: str = "foreign", text_col: str = "text") -> DataFrame:
    """All columns and lang_pred, score, bits and foreign, in one pass over the rows.

    ``und``, 0, 0 and false if the text is null or has no letter, or if no language was learned; ties go to the language
    that sorts first.  ``bits`` is the least cross-parsing entropy for a byte; ``foreign`` says that in each
    language the text is far above that language's own (FOREIGN, SLACK), so that it is in none that was learned.
    """
    b = docs.sparkSession.sparkContext.broadcast(references)
    text = F.col(text_col).cast("string")
    has = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    given = isinstance(docs.schema[text_col].dataType, StringType)
    at = docs.columns.index(text_col) if given else len(docs.columns)
    both = docs.select("*", *([] if given else [text.alias("__text")]), has.alias("__letters"))
    made = {"__lang": ("__lang", StringType()), "__score": ("__score", DoubleType()), "__bits": ("__bits", DoubleType()), "__foreign": ("__foreign", BooleanType())}
    out = with_kernel(both, _scorer(b, f"c{at}"), made)
    when = lambda c, other: F.when(F.col("__letters"), F.col(c)).otherwise(other)
    return out.select(*docs.columns, when("__lang", UNKNOWN).alias(lang), when("__score", 0.0).alias(score), when("__bits", 0.0).alias(bits), when("__foreign", False).alias(foreign))


def identify(docs: DataFrame, references: list[Reference]) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (0 to 1), bits and foreign, as ``tagged`` has them.

    Rows that repeat get a row each; only doc_id and text are read, whatever other columns there are.
    """
    workers_find_package(docs.sparkSession)
    found = tagged(docs.select("doc_id", "text"), references)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits", "foreign")
