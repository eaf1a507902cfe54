"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of 13 words, a window into shingles of up to five words.  Shingles are ranked
by how often the documents hold them.  A window occurs only where all its shingles do, so its prefix is the single
rarest one: documents are joined on that shingle alone, its offset in the window gives the one place where the window
can start, positional and length bounds drop places outside the text, and the words are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as X
from .common import ROW, intermediate, returned, stored, workers_find_package

WINDOW = 13
SHINGLE = 5
#: Documents drop shingles that no benchmark item has by a bit table of 2 ** bits bits, SPARE for each shingle of the benchmark
#: between these bounds (128 kB and 32 MB); shingles that pass it by chance are dropped by the join.
LEAST_BITS, MOST_BITS, SPARE = 20, 28, 64


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside = X.table("alnum")
    for batch in batches:
        for part, raw, off in X.blocks(batch, "text"):
            data = X.lowered(raw)
            w = X.words(data, off, inside)
            h = X.span_hash(X.prefix_codes(data), w.start, w.end)
            flat, ids, rows = data.tobytes(), part.column("item_id"), []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                n = min(WINDOW, b - a)
                k = min(SHINGLE, n)
                for s in range(a, b - n + 1) if n else ():
                    text = b" ".join(flat[w.start[j] : w.end[j]] for j in range(s, s + n)).decode(errors="replace")
                    rows.append((ids[i].as_py(), text, int(n), int(k), X.as_long(X.ngrams(h[s : s + n], k)).tolist()))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["item_id", "window", "n", "k", "shingles"])


def benchmark_windows(bench: DataFrame) -> DataFrame:
    """Rows (item_id, window, n, k, shingles): each window's words, their number, the shingles' size and hashes.

    An item of fewer than 13 words is one window, one without words has none.
    """
    workers_find_package(bench.sparkSession)
    rows = bench.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(X.tidy(_windows), "item_id string, window string, n int, k int, shingles array<bigint>")


def _hits(bits, sizes):
    margin, width = WINDOW, int(np.log2(len(bits.value) * 8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, seen, ks = X.table("alnum"), np.frombuffer(bits.value, np.uint64), sizes
        for batch in batches:
            for part, raw, off in X.blocks(batch, "text"):
                data = X.lowered(raw)
                w = X.words(data, off, inside)
                h = X.span_hash(X.prefix_codes(data), w.start, w.end)
                doc, flat = w.doc, None
                pos, sh, size = [], [], []
                for k in ks:
                    s = X.ngrams(h, k)
                    slot = s >> np.uint64(64 - width)
                    there = (seen[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                    at = np.flatnonzero(there)
                    at = at[doc[at] == doc[at + k - 1]]
                    pos.append(at), sh.append(s[at]), size.append(np.full(len(at), k))
                pos, sh, size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (pos, sh, size))
                order = np.argsort(pos, kind="stable")
                pos, sh, size = pos[order].astype(np.int64), sh[order].astype(np.uint64), size[order].astype(np.int64)
                begin, end = w.first[doc[pos]], w.first[doc[pos] + 1]
                lo, hi = np.maximum(begin, pos - margin + size), np.minimum(end, pos + margin)
                around = []
                if len(pos):
                    flat = data.tobytes()
                    a, b = w.start.tolist(), w.end.tolist()
                    around = [b" ".join([flat[a[j] : b[j]] for j in range(x, y)]).decode(errors="replace") for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
                cuts = np.searchsorted(pos, w.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"), part.column("doc_id"), pa.array(w.counts),
                        X.list_array(X.as_long(sh), cuts), X.list_array((pos - begin).astype(np.int64), cuts),
                        X.list_array((pos - lo).astype(np.int32), cuts), X.list_array(pa.array(around, pa.string()), cuts),
                    ],
                    names=["uid", "doc_id", "n_words", "shingle", "pos", "before", "around"],
                )

    return run


def decontaminate(docs: DataFrame, bench: DataFrame, *, num: int = 1, den: int = 20) -> DataFrame:
    """Per document: uid, doc_id, n_words, n_hit, n_items, item_ids and contaminated (n_hit > 0, den * n_hit >= num * n_words).

    ``docs`` has doc_id and text, ``bench`` item_id and text; other columns are not read, whatever their names.
    Null and wordless texts have no words and no hits, and are not contaminated.  Rows that repeat a doc_id, also a null
    one, each get a row.  A null item_id marks words but is in no list; items that repeat count once.  An empty
    benchmark contaminates nothing.  Texts of any length are worked on in blocks of two megabytes or one text.
    """
    workers_find_package(docs.sparkSession)
    with intermediate(docs.sparkSession):
        return returned(_decontaminate(docs, bench, num, den), "contamination")


def _decontaminate(docs: DataFrame, bench: DataFrame, num: int, den: int) -> DataFrame:
    spark = docs.sparkSession
    items = stored(benchmark_windows(bench), "windows")
    wins = items.groupBy("window").agg(F.first("n").alias("n"), F.first("k").alias("k"), F.first("shingles").alias("shingles"))
    # at most 2 ** (MOST_BITS - 6) rows of 64 bits come to the driver
    shingles = items.select(F.explode("shingles").alias("s"))
    there = shingles.agg(F.approx_count_distinct("s")).first()[0]
    width = min(MOST_BITS, max(LEAST_BITS, int(np.ceil(np.log2(SPARE * there + 1)))))
    slot = F.shiftrightunsigned("s", 64 - width)
    words = shingles.select(F.shiftright(slot, 6).alias("at"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    bits = np.zeros(1 << (width - 6), np.uint64)
    for row in words.toLocalIterator():
        bits[row["at"]] = row["bits"] & 0xFFFFFFFFFFFFFFFF
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # 1 to 5
    rows = docs.select(F.col(ROW).alias("uid") if ROW in docs.columns else F.monotonically_increasing_id().alias("uid"), "doc_id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        X.tidy(_hits(spark.sparkContext.broadcast(bits.tobytes()), sizes)),
        f"uid bigint, doc_id {id_type}, n_words bigint, shingle array<bigint>, pos array<bigint>, before array<int>, around array<string>",
    )
    found = stored(found, "hits")
    hits = found.where(F.size("shingle") > 0).select("uid", F.explode(F.arrays_zip("shingle", "pos", "before", "around")).alias("h")).select("uid", "h.*")
    often = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = wins.select("window", "n", F.posexplode("shingles").alias("offset", "shingle")).join(often, "shingle", "left")
    prefix = ranked.groupBy("window").agg(F.min_by(F.struct("shingle", "offset", "n"), F.struct(F.coalesce("often", F.lit(0)), "shingle", "offset")).alias("p")).select("window", "p.*")
    placed = hits.join(prefix, "shingle").where(F.col("offset") <= F.col("before"))
    there = F.split("around", " ")
    placed = placed.where(F.col("before") - F.col("offset") + F.col("n") <= F.size(there))
    placed = placed.where(F.array_join(F.slice(there, F.col("before") - F.col("offset") + 1, F.col("n")), " ") == F.col("window"))
    occurs = stored(placed.select("uid", (F.col("pos") - F.col("offset")).alias("start"), (F.col("pos") - F.col("offset") + F.col("n")).alias("stop"), "window"), "occurrences")
    before = Window.partitionBy("uid").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
    covered = occurs.groupBy("uid", "start").agg(F.max("stop").alias("stop")).select("uid", fresh.alias("fresh")).groupBy("uid").agg(F.sum("fresh").cast("bigint").alias("n_hit"))
    named = occurs.select("uid", "window").distinct().join(items.select("window", "item_id").where("item_id is not null").distinct(), "window").groupBy("uid").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    out = found.select("uid", "doc_id", "n_words").join(covered, "uid", "left").join(named, "uid", "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)).cast("bigint"), F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select(
        "uid", "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"), ids.alias("item_ids"),
        ((n_hit > 0) & (den * n_hit >= num * F.col("n_words"))).alias("contaminated"),
    )
