"""Quality rules and n-gram perplexity.

A modified Kneser-Ney model of code points, order four, is counted and estimated by Spark over all texts, one for each
language.  A four-gram is packed into 64 bits, 16 for each code point, so a context is a shift and a suffix a mask away, and all
tables stay exact.  The probabilities that a scan needs go to it as arrays sorted by hash.  Documents whose perplexity lies
outside their language's band are rejected: far above it is text unlike its language, far below it is text that repeats itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textops as X
from .common import intermediate, returned, stored, with_numbers, ROW, workers_find_package

U64 = np.uint64
ORDER = 4
#: Documents without a language are a group of their own, with a model and a band as any other.
NONE = ""
#: Bands reach so many times the middle half's width beyond the quartiles: so few that texts with signs after their words,
#: tables and capitals fall outside, and so many that clean texts stay (measured by kind, see the README).
BELOW, ABOVE = 1.5, 1.5
#: Shorter texts vary more: their bands widen with the root of this many characters over their own.
FULL_CHARS = 1000.0
_STEP = 0.002
#: N-grams that are broadcast at a time, 12 bytes each; a larger model is looked up in several scans, whose sums add up.
ENTRIES = 4 << 20
#: Distinct n-grams that a task holds before it sends them on.
_HELD = 4 << 20


def symbols(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each text in 16 bits, and n + 1 offsets.

    A-Z are in lower case, blanks and controls one sign, digits another; code points beyond 16 bits are folded into the
    range that no character has.
    """
    try:
        text, cut = raw.tobytes().decode(), np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
    except UnicodeDecodeError:
        texts = [raw[a:b].tobytes().decode(errors="replace") for a, b in zip(off[:-1], off[1:], strict=True)]
        text, cut = "".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    high = c >= 0x10000
    low = np.arange(0x10000, dtype=np.uint16)
    low[0x41:0x5B] += 32
    low[:0x21], low[0x30:0x3A] = 0x20, 0x30
    return low[np.where(high, 0xD800 + c % 0x800, c)], cut.astype(np.int64)


def gram_codes(c: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The four symbols that end at each place, packed; a text begins after three blanks."""
    out = c.astype(U64)
    for back in range(1, ORDER):
        before = np.full(len(c), 0x20, np.uint16)
        before[back:] = c[:-back] if back < len(c) else c[:0]
        for k in range(back):
            at = off[:-1] + k
            before[at[at < off[1:]]] = 0x20
        out |= before.astype(U64) << U64(16 * back)
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    size = fresh = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for name, parts in held.items():
            keys, n = _merged(parts)
            for a in range(0, len(keys), 1 << 18):
                k = keys[a : a + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(k), pa.string()), pa.array(X.as_long(k)), pa.array(n[a : a + (1 << 18)])], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for part, raw, off in X.blocks(batch, "text"):
            lang = part.column("lang").fill_null(NONE).to_numpy(zero_copy_only=False)
            c, cut = symbols(raw, off)
            codes, sizes = gram_codes(c, cut), np.diff(cut)
            for name in np.unique(lang):
                own = np.unique(codes[np.repeat(lang == name, sizes)], return_counts=True)
                held.setdefault(name, []).append(own)
                fresh += len(own[0])
            if fresh > _HELD // 4:
                held = {name: [_merged(parts)] for name, parts in held.items()}
                size, fresh = sum(len(p[0][0]) for p in held.values()), 0
                if size > _HELD:
                    yield from sent()
    yield from sent()


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts; a task sums its own before the shuffle."""
    workers_find_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")
    return rows.mapInArrow(X.tidy(_count), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND(F.lit((1 << 16 * order) - 1))


class Model(NamedTuple):
    """For each order from 1: probabilities (lang, gram, p) of the n-grams seen and back-off weights (lang, context, gamma); and
    the share of a symbol never seen (lang, p0)."""

    grams: tuple[DataFrame, ...]
    contexts: tuple[DataFrame, ...]
    floor: DataFrame


def _discounts(counted: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the counts of counts: a row for each language."""
    n = counted.groupBy("lang").agg(*[F.sum((F.col("n") == k).cast("bigint")).cast("double").alias(f"n{k}") for k in range(1, 5)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    clipped = lambda c, most: F.least(F.lit(most), F.greatest(F.lit(0.05), c))
    enough = (F.col("n1") > 0) & (F.col("n2") > 0)
    raw = (1 - 2 * y * F.col("n2") / F.col("n1"), 2 - 3 * y * F.col("n3") / F.col("n2"), F.when(F.col("n3") > 0, 3 - 4 * y * F.col("n4") / F.col("n3")).otherwise(1.0))
    return n.select("lang", *[F.when(enough, clipped(d, most)).otherwise(0.5).alias(f"d{k}") for k, (d, most) in enumerate(zip(raw, (0.95, 1.9, 2.9), strict=True), 1)])


def estimate(counts: DataFrame) -> Model:
    """Modified Kneser-Ney estimates from (lang, gram, n): raw counts in the highest order, below it the number of different
    symbols before an n-gram.  All steps are groupings, windows over one context and joins on n-grams."""
    counted = {ORDER: stored(counts, "grams")}
    for order in range(ORDER - 1, 0, -1):
        counted[order] = stored(counted[order + 1].groupBy("lang", _suffix(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams")
    lower = floor = stored(counted[1].groupBy("lang").agg((1.0 / F.count(F.lit(1))).alias("p0")), "floor")
    grams, contexts = [], []
    for order in range(1, ORDER + 1):
        context = F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0).cast("bigint")
        rows = counted[order].join(F.broadcast(_discounts(counted[order])), "lang").withColumn("context", context)  # a row for each language
        w = Window.partitionBy("lang", "context")
        many = lambda k: F.sum(((F.col("n") == k) if k < 3 else (F.col("n") >= 3)).cast("bigint")).over(w)
        own = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        gamma = (F.col("d1") * many(1) + F.col("d2") * many(2) + F.col("d3") * many(3)) / F.sum("n").over(w)
        rows = rows.select("lang", "gram", "context", ((F.col("n") - own) / F.sum("n").over(w)).alias("top"), gamma.alias("gamma"))
        rows = stored(rows, "contexts")
        if order == 1:
            joined = rows.join(F.broadcast(lower), "lang")  # a row for each language
        else:
            joined = rows.withColumn("suffix", _suffix(F.col("gram"), order - 1)).join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("p0")), ["lang", "suffix"])
        lower = stored(joined.select("lang", "gram", (F.col("top") + F.col("gamma") * F.col("p0")).alias("p")), "probabilities")
        grams.append(lower)
        contexts.append(rows.select("lang", "context", "gamma").distinct())
    return Model(tuple(grams), tuple(contexts), floor)


def price(grams: DataFrame, model: Model) -> DataFrame:
    """(lang, gram, logp) for each of (lang, gram): what the model has, and backed off for what it hasn't seen."""
    known = grams.select("lang", "gram").join(model.grams[-1], ["lang", "gram"]).select("lang", "gram", F.log10("p").alias("logp"))
    new = stored(grams.select("lang", "gram").join(model.grams[-1], ["lang", "gram"], "left_anti"), "unseen")
    if new.isEmpty():
        return known
    new = new.join(F.broadcast(model.floor), "lang", "left").withColumn("p0", F.coalesce("p0", F.lit(1.0 / 65536)))  # a row for each language
    for order in range(1, ORDER + 1):
        key = _suffix(F.col("gram"), order)
        context = F.shiftrightunsigned(key, 16) if order > 1 else F.lit(0).cast("bigint")
        new = new.withColumns({"key": key, "context": context})
        new = new.join(model.grams[order - 1].select("lang", F.col("gram").alias("key"), "p"), ["lang", "key"], "left").join(model.contexts[order - 1], ["lang", "context"], "left")
        p = F.coalesce("p", F.coalesce("gamma", F.lit(1.0)) * F.col("p0"))
        new = new.select("lang", "gram", p.alias("p0"))
    return known.unionByName(new.select("lang", "gram", F.log10("p0").alias("logp")))


def _salt(lang: str) -> int:
    data = np.frombuffer(lang.encode() or b" ", np.uint8)
    return int(X.span_hash(X.prefix_codes(data), np.array([0]), np.array([len(data)]))[0])


def _keys(lang: str, grams: np.ndarray) -> np.ndarray:
    return X.mix(grams * U64(0x9E3779B97F4A7C15) ^ U64(_salt(lang)))


class Sorted:
    """Values by hash: keys in order, and where each run of equal leading bits begins."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(1, int(len(keys)).bit_length())
        self.shift = U64(64 - bits)
        self.first = np.searchsorted(keys >> self.shift, np.arange(1 << bits, dtype=U64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, 0 for those that aren't there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.float32)
        last = len(self.keys) - 1
        slot = np.minimum(self.first[(keys >> self.shift).astype(np.int64)], last)
        behind = np.flatnonzero(self.keys[slot] < keys)
        while len(behind):
            slot[behind] += 1
            behind = behind[slot[behind] <= last]
            behind = behind[self.keys[slot[behind]] < keys[behind]]
        slot = np.minimum(slot, last)
        return np.where(self.keys[slot] == keys, self.values[slot], np.float32(0))


def _arrays(priced: DataFrame) -> tuple[bytes, bytes]:
    """Keys and values of at most about ENTRIES n-grams, sorted by key."""
    t = priced.toArrow()
    lang, gram = t.column("lang").to_pandas().to_numpy(), t.column("gram").to_numpy().astype(np.int64).view(U64)
    keys = np.zeros(len(gram), U64)
    for name in np.unique(lang) if len(lang) else ():
        own = lang == name
        keys[own] = _keys(name, gram[own])
    order = np.argsort(keys)
    return keys[order].tobytes(), t.column("logp").to_numpy().astype(np.float32)[order].tobytes()


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Word, symbol and repetition counts of each text."""
    inside = X.table("spaced")
    codes = X.prefix_codes(data)
    w = X.words(data, off, inside)
    chars = inside[data] & ((data & 0xC0) != 0x80)
    symbols = np.zeros(256, bool)
    symbols[[ord(c) for c in "#*$%&|<>"]] = True
    # lines: they begin at a text's start and after each newline
    nl = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([off[:-1], nl + 1]))
    owner = np.searchsorted(off, start, side="right") - 1
    full = (start < len(data)) & (owner < len(off) - 1)
    start, owner = start[full], owner[full]
    stop = np.minimum(np.append(nl, len(data))[np.searchsorted(nl, start)], off[owner + 1])
    worded = np.concatenate([[0], np.cumsum(inside[data])])
    has = worded[stop] > worded[start]
    line, by = X.span_hash(codes, start[has], stop[has]), np.searchsorted(owner[has], np.arange(len(off)))
    _, distinct = X.distinct_within(line, by)
    # five-word windows found twice or more in their text
    h = X.span_hash(codes, w.start, w.end)
    s, pos, per = X.shingles(h, w.first, 5, short=False)
    key = X.mix(s + np.repeat(np.arange(len(per) - 1), np.diff(per)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    again = pos[order[same[1:] | same[:-1]]]
    cover = np.zeros(len(h) + 6, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 5, -1)
    covered = (np.cumsum(cover)[: len(h)] > 0).astype(np.int64)
    return {
        "n_words": w.counts, "word_chars": X.sums(chars.astype(np.int64), off), "n_symbols": X.sums(symbols[data].astype(np.int64), off),
        "n_dup_lines": np.diff(by) - np.diff(distinct), "n_repeat_words": X.sums(covered, w.first),
    }


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _scored(model, whole: bool):
    """Sums of log10 probabilities; with ``whole`` also the base counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = model.value
        there = Sorted(np.frombuffer(keys, U64), np.frombuffer(values, np.float32))
        for batch in batches:
            for part, raw, off in X.blocks(batch, "text"):
                lang = part.column("lang").to_numpy(zero_copy_only=False)
                c, cut = symbols(raw, off)
                codes, sizes = gram_codes(c, cut), np.diff(cut)
                for name in np.unique(lang):
                    own = np.repeat(lang == name, sizes)
                    codes[own] = _keys(name, codes[own])
                logp = X.sums(there.find(codes).astype(np.float64), cut)
                cols = [part.column("uid"), pa.array(logp)]
                if whole:
                    counts = base_counts(raw, off)
                    cols += [part.column("doc_id"), part.column("lang"), pa.array(sizes), *(pa.array(counts[k].astype(np.int64)) for k in _COUNTS)]
                yield pa.RecordBatch.from_arrays(cols, names=["uid", "logp", *(["doc_id", "band", "n_chars", *_COUNTS] if whole else [])])

    return run


def bands(scored: DataFrame) -> DataFrame:
    """Per language: quartiles of log10 perplexity for each character, over all its documents of ten words or more.

    Quartiles are read from a histogram in steps of 0.002, so they are the same however the rows are dealt.
    """
    bins = scored.where("n_words >= 10").groupBy("band", F.floor(F.col("log_perplexity") / _STEP).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    by = bins.groupBy("band").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("h"), F.sum("n").alias("total"))  # a log10 has a few thousand steps
    at = lambda q: F.element_at(F.filter(F.transform("h", lambda x, i: F.struct(x["bin"].alias("bin"), F.aggregate(F.slice("h", 1, i + 1), F.lit(0).cast("bigint"), lambda a, y: a + y["n"]).alias("upto"))), lambda x: x["upto"] >= q * F.col("total")), 1)["bin"] * _STEP
    return by.select("band", at(0.25).alias("q1"), (at(0.75) + _STEP).alias("q3"))


def judge(docs: DataFrame, learned_from: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, log_perplexity, its band's bounds, kept and model (the language).

    The model is estimated from ``learned_from``, or from ``docs`` itself.  Null texts have no words and perplexity 0; fewer
    than ten words, or repeated five-word windows over more than a fifth of the words, fail the base rules.  Rows that repeat
    get a row each; only doc_id, text and lang are read.  An empty table gives no rows.  The result is a stored table.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    with intermediate(spark):
        counts = stored(gram_counts(docs if learned_from is None else learned_from), "counts")
        grams = counts if learned_from is None else stored(gram_counts(docs), "counts")
        return returned(_judged(docs, stored(price(grams, estimate(counts)), "prices")), "quality")


def _judged(docs: DataFrame, priced: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    rows = with_numbers(docs.select("doc_id", "lang", "text"))
    rows = rows.select(F.col(ROW).alias("uid"), "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scans = max(1, -(-priced.count() // ENTRIES))
    share = F.pmod(F.xxhash64("lang", "gram"), F.lit(scans))
    base, more = None, []
    for k in range(scans):
        b = spark.sparkContext.broadcast(_arrays(priced.where(share == k)))
        if base is None:
            base = stored(rows.mapInArrow(X.tidy(_scored(b, True)), f"uid bigint, logp double, doc_id {kind}, band string, n_chars bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)), "scored")
        else:
            more.append(stored(rows.select("uid", "lang", "text").mapInArrow(X.tidy(_scored(b, False)), "uid bigint, logp double"), "scored"))
        b.unpersist()
    for part in more:
        base = base.join(part.withColumnRenamed("logp", "more"), "uid").withColumn("logp", F.col("logp") + F.col("more")).drop("more")
    scored = base.withColumn("log_perplexity", 0.0 - F.col("logp") / F.greatest("n_chars", F.lit(1)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    out = scored.join(F.broadcast(bands(scored)), "band", "left")  # a row for each language
    reach = (F.col("q3") - F.col("q1")) * F.greatest(F.lit(1.0), F.sqrt(FULL_CHARS / F.greatest("n_chars", F.lit(1))))
    out = out.withColumn("low", F.col("q1") - BELOW * reach).withColumn("high", F.col("q3") + ABOVE * reach)
    return out.select("doc_id", *_COUNTS, failed.alias("base_failed"), (~failed & inside).alias("kept"), "log_perplexity", "low", "high", F.col("band").alias("model"))
