"""Removal of repeated lines and passages by hashed units.

A unit is a line, or in a line of MIN_RUN words or more a part that ends after ``.``, ``!`` or ``?`` or begins with a capital after a
lower-case word, so that a passage set into another's line is found; such a part has four words at least.  With ``from_words`` long
lines are also cut where the words beside say so, and nothing else, so that equal passages have equal units in any host and
script.  Units are normalised (A-Z in lower case, white space as one blank), their digests grouped over all documents, and all but
the earliest by (doc_id, row, place) are repeats.  Every repeated line is taken out, whatever its length; repeated parts of lines are
taken out where they and the repeats beside them make a run of MIN_RUN words, since shorter wordings come again by chance,
and the more so the more text there is.  A passage that was broken into other lines has other units.  Spans keep the original offsets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import textops as X
from .common import ROW, intermediate, numbered, require_integer, returned, stored, with_kernel, with_numbers, workers_find_package

U64 = np.uint64
#: Words of a part of a line, and of repeated units together of which parts of lines are taken out.
MIN_UNIT, MIN_RUN = 4, 20
#: Words on either side below whose hashes one must lie to begin a unit ``from_words``.
BESIDE = 3
#: Bytes of text whose units are looked through for repeats before they are sent.
_BLOCK = 2 << 20


def _least_cuts(data: np.ndarray, w: X.Words, line: np.ndarray, soft: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Lines, sentences that begin MIN_UNIT words or more after any other, and in ``long`` lines each word of least hash among its neighbours."""
    n = len(line)
    at = np.append(np.flatnonzero(line | soft), n)
    far = np.diff(at, prepend=-n)[:-1] >= MIN_UNIT
    cut = line.copy()
    cut[at[:-1][far]] = True
    begin = np.flatnonzero(cut)
    part = np.cumsum(cut) - 1
    place = np.arange(n)
    inside = long & (place - begin[part] >= MIN_UNIT) & (np.append(begin[1:], n)[part] - place >= MIN_UNIT)
    h = X.span_hash(X.prefix_codes(X.lowered(data)), w.start, w.end)
    h[:-1] = X.mix(h[:-1] * U64(3) + h[1:])
    least = inside.copy()
    for k in range(1, BESIDE + 1):
        least[k:] &= (h[k:] < h[:-k]) | ~inside[:-k] | (part[k:] != part[:-k])
        least[:-k] &= (h[:-k] <= h[k:]) | ~inside[k:] | (part[:-k] != part[k:])
    return cut | least


class Units(NamedTuple):
    words: X.Words
    begin: np.ndarray  #: first word of each unit
    cut: np.ndarray  #: n + 1 unit indexes at which the texts begin
    whole: np.ndarray  #: whether a unit is a whole line


def _found(w: X.Words, line: np.ndarray, begin: np.ndarray) -> Units:
    return Units(w, begin, np.searchsorted(begin, w.first), line[begin] & np.append(line, True)[np.append(begin[1:], len(w.start))])


def units(data: np.ndarray, off: np.ndarray, from_words: bool = False) -> Units:
    """The units of each text."""
    w = X.words(data, off, X.table("spaced"))
    n = len(w.start)
    if not n:
        none = np.zeros(0, np.int64)
        return Units(w, none, np.zeros(len(off), np.int64), np.zeros(0, bool))
    first = np.zeros(n, bool)
    first[w.first[:-1][w.counts > 0]] = True
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    line = first.copy()
    line[1:] |= breaks[w.start[1:]] > breaks[w.end[:-1]]
    head, tail = data[w.start], data[w.end - 1]
    after = data[np.minimum(w.start + 1, len(data) - 1)]
    capital = ((head >= 0x41) & (head <= 0x5A)) | ((head == 0xC3) & (after >= 0x80) & (after <= 0x9E))
    ends = np.isin(tail, np.frombuffer(b".!?", np.uint8))
    soft = np.zeros(n, bool)
    soft[1:] = ends[:-1] | (capital[1:] & ~capital[:-1])
    number = np.cumsum(line) - 1
    long = np.bincount(number)[number] >= MIN_RUN
    soft &= long
    if from_words:
        return _found(w, line, np.flatnonzero(_least_cuts(data, w, line, soft, long)))
    # within a line, a cut counts only MIN_UNIT words or more after the one before
    cut = line.copy()
    last = -1
    for i, hard in zip((at := np.flatnonzero(line | soft)).tolist(), line[at].tolist(), strict=True):
        if hard or i - last >= MIN_UNIT:
            cut[i] = True
            last = i
    return _found(w, line, np.flatnonzero(cut))


def _digests(data: np.ndarray, w: X.Words, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = X.span_hash(X.prefix_codes(X.lowered(data)), w.start, w.end)
    end, n = np.append(begin[1:], len(h)), len(h)
    out = []
    for salt in (0, 0x5851F42D4C957F2D):
        c = np.zeros(n + 1, U64)
        np.cumsum(X.mix(h ^ U64(salt)) * X._power(n + 1, False)[:n], out=c[1:])
        out.append(X.mix((c[end] - c[begin]) * X._power(n + 1, True)[begin] + (end - begin).astype(U64)))
    return out[0], out[1]


def _rows(from_words: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each unit; of equal ones in a block, only the earliest carries its digest, the others are known repeats."""
    for batch in batches:
        for part, raw, off in X.blocks(batch, "text", _BLOCK):
            u = units(raw, off, from_words)
            if not len(u.begin):
                continue
            a, b = _digests(raw, u.words, u.begin)
            doc = np.repeat(np.arange(len(off) - 1), np.diff(u.cut))
            pos = np.arange(len(doc)) - u.cut[doc]
            ids = part.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            rank = np.lexsort((np.arange(len(ids)), ids.fill_null(0).to_numpy(zero_copy_only=False), ~known))
            place = np.empty(len(ids), np.int64)
            place[rank] = np.arange(len(ids))
            order = np.lexsort((pos, place[doc], b, a))
            same = np.zeros(len(order), bool)
            same[1:] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
            repeat = np.zeros(len(order), bool)
            repeat[order] = same
            a[repeat] = X.mix((part.column("uid").to_numpy().view(U64)[doc] << U64(24)) + pos.astype(U64))[repeat]
            yield pa.RecordBatch.from_arrays(
                [pa.array(X.as_long(a)), pa.array(X.as_long(b)), ids.take(pa.array(doc)), part.column("uid").take(pa.array(doc)), pa.array(pos.astype(np.int32)), pa.array(repeat)], names=["a", "b", "doc_id", "uid", "pos", "repeat"]
            )


_CUT = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def _runs(flagged: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First unit and end of each run of equal flags in one text."""
    new = np.ones(len(flagged), bool)
    new[1:] = (flagged[1:] != flagged[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return at, np.append(at, len(flagged))[1:]


def _remove(from_words: bool, column: str, repeats_column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, off in X.blocks(batch, column):
            u = units(raw, off, from_words)
            w, begin, cut = u.words, u.begin, u.cut
            stop = np.append(begin[1:], len(w.start))
            size = stop - begin
            repeats = part.column(repeats_column)
            flagged = np.zeros(len(begin), bool)
            for i, r in enumerate(repeats):
                if r.is_valid:
                    flagged[cut[i] + np.array(r.values.to_numpy(zero_copy_only=False), np.int64)] = True
            doc = np.repeat(np.arange(len(off) - 1), np.diff(cut))
            # of runs of consecutive repeats of one text, long ones go whole, of others the lines
            at, ends = _runs(flagged, doc)
            if len(at):
                flagged &= u.whole | np.repeat(np.add.reduceat(size, at) >= MIN_RUN, ends - at)
            runs = [(int(a), int(b)) for a, b in zip(*_runs(flagged, doc), strict=True) if flagged[a]]
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            spans: list[list] = [[] for _ in range(len(off) - 1)]
            gone, words = np.zeros(len(off) - 1, np.int64), np.zeros(len(off) - 1, np.int64)
            cuts: list[list] = [[] for _ in range(len(off) - 1)]
            for a, b in runs:
                d = int(doc[a])
                x = int(w.start[begin[a]])
                y = int(w.start[stop[b - 1]]) if b < cut[d + 1] else int(off[d + 1])
                cuts[d].append((x, y))
                spans[d].append({"start": int(chars[x] - chars[off[d]]), "stop": int(chars[y] - chars[off[d]])})
                gone[d] += b - a
                words[d] += int(size[a:b].sum())
            flat, texts = raw.tobytes(), []
            for d in range(len(off) - 1):
                at, kept = int(off[d]), []
                for x, y in cuts[d]:
                    kept.append(flat[at:x])
                    at = y
                kept.append(flat[at : int(off[d + 1])])
                texts.append(b"".join(kept).decode(errors="replace"))
            text = pa.array(texts, pa.string(), mask=part.column(column).is_null().to_numpy(zero_copy_only=False))
            made = [text, pa.array(np.diff(cut)), pa.array(gone), pa.array(w.counts), pa.array(words), pa.array(spans, pa.list_(_CUT))]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *(f"__{i}" for i in range(len(made)))])


_MADE = ["kept_text", "n_units", "n_removed_units", "n_words", "n_removed_words", "removed"]
_SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("stop", LongType())]))
_KINDS = [StringType(), LongType(), LongType(), LongType(), LongType(), _SPANS]


def _repeats(rows: DataFrame, from_words: bool) -> DataFrame:
    """(uid, repeats): the places of each text's units that an earlier one equals.

    The earliest unit of a digest is found by a combining minimum, so that a common line has a row for each task in one place
    at most; the rows of one digest then meet it in a join, which Spark may split.  Texts are cut into units for each of the
    two: that costs less than to keep the units.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(X.tidy(partial(_rows, from_words)), f"a bigint, b bigint, doc_id {kind}, uid bigint, pos int, repeat boolean")
    # null doc_ids rank last, with the largest there could be
    rank = F.struct(F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("doc_id"), "uid", "pos")
    # of equal units in a block, all but one have a digest of their own and are known repeats
    earliest = found.where("not repeat").select("a", "b", rank.alias("at")).groupBy("a", "b").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earliest = stored(earliest.where("n > 1").select("a", "b", F.col("first.uid").alias("first_uid"), F.col("first.pos").alias("first_pos")), "earliest")
    met = found.select("a", "b", "uid", "pos", "repeat").join(earliest.hint("merge"), ["a", "b"], "left")
    again = met.where(F.col("repeat") | (F.col("first_uid") != F.col("uid")) | (F.col("first_pos") != F.col("pos")))
    return again.groupBy("uid").agg(F.collect_list("pos").alias("repeats"))


def with_kept_text(docs: DataFrame, from_words: bool = False, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and, under ``prefix``, kept_text, n_units, n_removed_units, n_words, n_removed_words and removed.

    One shuffle brings the texts to their repeats; see ``remove_repeats`` for what is removed.
    """
    require_integer(docs)
    workers_find_package(docs.sparkSession)
    mine = with_numbers(docs)
    with intermediate(docs.sparkSession):
        repeats = returned(_repeats(numbered(mine), from_words), "repeats")
    joined = mine.withColumn("__text", F.col("text").cast("string")).join(repeats.select(F.col("uid").alias(ROW), F.col("repeats").alias("__repeats")), ROW, "left")
    at = {c: f"c{i}" for i, c in enumerate(joined.columns)}
    made = {f"__{i}": (f"__made{i}", kind) for i, kind in enumerate(_KINDS)}
    out = with_kernel(joined, partial(_remove, from_words, at["__text"], at["__repeats"]), made)
    return out.select(*docs.columns, *[F.col(f"__made{i}").alias(prefix + name) for i, name in enumerate(_MADE)])


def remove_repeats(docs: DataFrame, from_words: bool = False) -> DataFrame:
    """Per document: doc_id, kept_text, n_units, n_removed_units, n_words, n_removed_words and removed, the spans taken out.

    Spans are character offsets into the text as it came, and end where the next kept word begins.  A null text stays null
    and has no units; an empty one stays empty.  Null doc_ids rank last; rows that repeat a doc_id rank by their place, so
    the second of two equal rows loses what it repeats.  Only the integer doc_id and text are read; a doc_id of another
    type is an error.
    """
    return with_kept_text(docs.select("doc_id", "text"), from_words).drop("text")
