"""Importance resampling towards a target text: n-gram weights from hashed counts, Gumbel keys, ranks by regular sampling.

Features are words and pairs of neighbouring words, hashed by CRC-32 into BUCKETS.  The gain of a bucket is the log ratio of its
smoothed shares in the target and in the documents; a document's weight is the mean gain of its features.  A seeded Gumbel
draw is added, so that the highest scores are a sample without replacement.  The order is found by parallel sorting by
regular sampling: each task sorts a run, evenly spaced rows of all runs give the splitters, rows are exchanged by
splitter, each segment is merged in its task, and the segments' counts make its ranks exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from . import textops as X
from .common import intermediate, require_integer, returned, stored, with_kernel, workers_find_package

BUCKETS = 10_000
#: Words that a document needs to be drawn, the share that is drawn (percent), the seed of the draw.
MIN_WORDS, PERCENT, SEED = 20, 25, 7
#: Evenly spaced rows that a run gives, and the most segments that runs are cut into: the splitters' bound.
SAMPLES, SEGMENTS = 64, 512
#: Bytes of a word up to which its hash comes from tables; longer ones are hashed by themselves.
_TABLED = 64
_U32 = np.uint32


@cache
def _step() -> np.ndarray:
    """CRC-32 of a byte, as the register's change when the byte is shifted in."""
    t = np.arange(256, dtype=_U32)
    for _ in range(8):
        t = np.where(t & _U32(1), (t >> _U32(1)) ^ _U32(0xEDB88320), t >> _U32(1))
    return t


@cache
def _after() -> tuple[np.ndarray, np.ndarray]:
    """[n, byte]: the part that a byte has in the register n bytes later; [n]: the start value's and the end's part for n bytes.

    The register is linear in its input, so the parts are combined by exclusive or.
    """
    s = _step()
    rows = [s]
    start = [_U32(0xFFFFFFFF)]
    for _ in range(_TABLED + 1):
        rows.append((rows[-1] >> _U32(8)) ^ s[rows[-1] & _U32(255)])
        start.append((start[-1] >> _U32(8)) ^ s[start[-1] & _U32(255)])
    return np.stack(rows), np.array(start, _U32) ^ _U32(0xFFFFFFFF)


@cache
def _moved() -> np.ndarray:
    """[n, k, byte]: what byte k of the register becomes when n zero bytes are shifted in."""
    s = _step()
    now = np.stack([np.arange(256, dtype=_U32) << _U32(8 * k) for k in range(4)])
    out = [now]
    for _ in range(_TABLED):
        now = (now >> _U32(8)) ^ s[now & _U32(255)]
        out.append(now)
    return np.stack(out)


def feature_buckets(data: np.ndarray, w: X.Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, and of each word with the next one of its text; ``data`` is in lower case.

    The second array has a place for every word; that of a text's last word is to be left out.
    """
    n = len(w.start)
    size = w.end - w.start
    crc = np.zeros(n, _U32)
    table, start = _after()
    short = size <= _TABLED
    crc[short] = start[size[short]]
    at = np.flatnonzero(short)
    for j in range(_TABLED):
        at = at[size[at] > j]
        if not len(at):
            break
        crc[at] ^= table[j][data[w.end[at] - 1 - j]]
    for i in np.flatnonzero(~short).tolist():
        crc[i] = zlib.crc32(data[w.start[i] : w.end[i]])
    pair = np.zeros(n, _U32)
    if n > 1:
        # with a blank behind it the first word's hash moves on by the length of the second
        blank = _step()[(crc[:-1] ^ _U32(0xFFFFFFFF) ^ _U32(32)) & _U32(255)] ^ ((crc[:-1] ^ _U32(0xFFFFFFFF)) >> _U32(8)) ^ _U32(0xFFFFFFFF)
        m, near = _moved(), short[1:]
        k, r = size[1:][near], blank[near]
        pair[:-1][near] = m[k, 0, r & _U32(255)] ^ m[k, 1, (r >> _U32(8)) & _U32(255)] ^ m[k, 2, (r >> _U32(16)) & _U32(255)] ^ m[k, 3, r >> _U32(24)] ^ crc[1:][near]
        for i in np.flatnonzero(~near).tolist():
            pair[i] = zlib.crc32(data[w.start[i + 1] : w.end[i + 1]], int(blank[i]))
    return crc % _U32(BUCKETS), pair % _U32(BUCKETS)


def _pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, X.Words]]:
    """(first row, lower-case bytes, words) of blocks of whole texts."""
    at = 0
    for part, raw, off in X.blocks(pa.RecordBatch.from_arrays([column], names=["t"]), "t"):
        data = X.lowered(raw)
        yield at, data, X.words(data, off, X.table("alnum"))
        at += part.num_rows


def _inner(w: X.Words) -> np.ndarray:
    """True for each word that another one of its text follows."""
    inner = np.ones(len(w.start), bool)
    inner[w.first[1:][w.counts > 0] - 1] = False
    return inner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each bucket that the task has seen."""
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, data, w in _pieces(batch.column(0)):
            one, two = feature_buckets(data, w)
            n += np.bincount(one, minlength=BUCKETS) + np.bincount(two[_inner(w)], minlength=BUCKETS)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: BUCKETS sums come to the driver, whatever the input."""
    workers_find_package(docs.sparkSession)
    out = np.zeros(BUCKETS, np.int64)
    for r in docs.select(F.col("text").cast("string").alias("text")).mapInArrow(X.tidy(_count), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    s, t = documents.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def _weigh(gain, column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    g = gain.value
    for batch in batches:
        n, total = np.zeros((2, batch.num_rows), np.int64)
        for at, data, w in _pieces(batch.column(column)):
            one, two = feature_buckets(data, w)
            both = g[one] + np.where(_inner(w), g[two], 0)
            rows = slice(at, at + len(w.counts))
            n[rows] = np.maximum(2 * w.counts - 1, 0)
            total[rows] = X.sums(both, w.first)
        weight = np.where(n > 0, total // np.maximum(n, 1), 0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), pa.array(weight)], names=[*batch.schema.names, "__n", "__weight"])


def weighed(docs: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """All columns of ``docs``, n_features and weight (the floored mean of gains; 0 without a word)."""
    b = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers
    made = {"__n": ("n_features", LongType()), "__weight": ("weight", LongType())}
    return with_kernel(docs.withColumn(text, F.col(text).cast("string")), partial(_weigh, b, f"c{docs.columns.index(text)}"), made)


def _ordered(columns: list[np.ndarray]) -> np.ndarray:
    """Bytes that sort as the rows of these signed columns do."""
    if not len(columns[0]):
        return np.zeros(0, f"S{8 * len(columns)}")
    flat = (np.stack(columns, axis=1).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
    return flat.view(f"S{8 * len(columns)}").ravel()


def _segment(splitters, keys: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = _ordered([batch.column(k).to_numpy() for k in keys])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.searchsorted(splitters.value, own, side="right").astype(np.int32))], names=[*batch.schema.names, "segment"])


def ranked(rows: DataFrame, keys: list[str], rank: str = "rank") -> DataFrame:
    """Add ``rank`` 1, 2, ... over all rows by ``keys``, ascending long columns without nulls; equal rows in a fixed order of their runs.

    Parallel sorting by regular sampling.  A run is what a task of ``rows`` holds; SAMPLES rows of each at most come to the driver,
    and no segment holds more than its share and one spacing of each run, however many rows have one key.
    """
    spark = rows.sparkSession
    with intermediate(spark):
        run = rows.sortWithinPartitions(*keys).withColumn("id", F.monotonically_increasing_id())
        runs = stored(run, "runs")
        of, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
        sizes = runs.groupBy(of.alias("run")).agg(F.count(F.lit(1)).alias("n"))  # a row for each run
        every = F.greatest(F.lit(1), F.ceil(F.col("n") / SAMPLES)).cast("bigint")
        order = [*keys, "id"]
        regular = runs.withColumn("run", of).join(sizes.hint("broadcast"), "run").where((place + F.floor(every / 2)) % every == 0).select(*order).toPandas()
        samples = np.sort(_ordered([regular[k].to_numpy(np.int64) for k in order]))
        parts = min(SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        cuts = np.unique(samples[len(samples) * np.arange(1, parts) // parts]) if len(samples) else samples
        splitters = spark.sparkContext.broadcast(cuts)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
        dealt = runs.mapInArrow(partial(_segment, splitters, order), f"{kinds}, segment int")
        merged = stored(dealt.repartitionById(len(cuts) + 1, F.col("segment")).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1), "segments")
        before, counts = [0] * (len(cuts) + 1), {r["segment"]: r["count"] for r in merged.groupBy("segment").count().collect()}  # SEGMENTS rows at most
        for s in range(1, len(before)):
            before[s] = before[s - 1] + counts.get(s - 1, 0)
        first = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in before]), F.col("segment") + 1)
        return returned(merged.select(*rows.columns, (first + F.col("place")).alias(rank)), "ranked")


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Per document: doc_id, n_features, weight, score and rank (null unless drawn), as long.

    Of the documents with MIN_WORDS words or more, PERCENT of a hundred are drawn, those of the highest scores, ties to the smaller
    doc_id and null doc_ids last.  Null, empty and wordless texts have no features, weight 0 and are never drawn; an empty target
    gives gains all the same; rows that repeat a doc_id are drawn each for itself, those with fewer features first.  Only
    doc_id and text are read; a doc_id of another type than an integer is an error.
    """
    require_integer(docs)
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs), bucket_counts(target))
    one = weighed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), gain).drop("text")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")
    with intermediate(spark):
        scored = stored(one.withColumn("score", score), "scored")
        enough = F.col("n_features") >= 2 * MIN_WORDS - 1
        drawn = scored.where(enough).count() * PERCENT // 100
        keyed = scored.where(enough).select("doc_id", "n_features", "weight", "score", (-F.col("score")).alias("k1"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("k2"), F.col("n_features").alias("k3"))
        places = ranked(keyed, ["k1", "k2", "k3"])
        own = places.select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
        return returned(own.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))), "resampled")
