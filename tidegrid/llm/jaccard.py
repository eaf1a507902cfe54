"""Exact n-gram Jaccard join by vertical partitioning.

Texts become sets of hashed five-word shingles; texts with equal sets are one class, and only classes are joined.

1. A text that shares 75 % of its set with another shares part of its prefix in any global order.  In hash order, the first
   40 % of each set are counted by fragments of the hash range; classes that share too few of them drop out.
2. For the rest the global order is by frequency.  Shingles of one class only come first and are never sent; of what
   follows, the classical prefix makes candidates.
3. In each shingle's bucket one class, the one with the commonest shingles, is the centre and is paired with all others: a
   bucket makes as many pairs as it has rows.  Members that end up in another component than their centre are then paired
   with the whole bucket, under length and positional bounds.
4. The frequency order is cut into fragments; each counts its part of a pair's overlap, and the parts are summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .common import by_number, intermediate, numbered, partitions_for, returned, stored, workers_find_package
from .graph import components

U64 = np.uint64
K = 5
#: J >= NUM / DEN
NUM, DEN = 75, 100
#: Further share of the set, beyond the classical prefix, that goes into the first count; so much of it must be shared.
EXTRA = 15
FRAGMENTS = 4
#: A shingle that so many sets of one block hold counts as frequent without being sent for each.
FREQUENT, _FREQUENT_DF = 64, 1 << 30
_HELD = 4 << 20


def _sets(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = X.lowered(raw)
    w = X.words(data, off, X.table("spaced"))
    h = X.span_hash(X.prefix_codes(data), w.start, w.end)
    s, _, per = X.shingles(h, w.first, K, short=True)
    return X.distinct_within(s, per)


def _names(values: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set."""
    return tuple(X.sums(X.as_long(X.mix(values ^ U64(salt))), cut) for salt in (0x5BD1E995CAFEF00D, 0x27D4EB2F165667C5))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, off in X.blocks(batch, "text"):
            values, cut = _sets(raw, off)
            a, b = _names(values, cut)
            yield pa.RecordBatch.from_arrays([part.column("uid"), part.column("doc_id"), pa.array(np.diff(cut)), pa.array(a), pa.array(b)], names=["uid", "doc_id", "n", "name", "name2"])


_SENT = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("owners", pa.binary()), ("sizes", pa.binary()), ("values", pa.binary())])
_SENT_SQL = "part int, batch bigint, owners binary, sizes binary, values binary"


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(uids, values, offsets) of the sets of about _HELD bytes of text at a time."""
    ids, vals, sizes, n = [], [], [], 0
    for batch in batches:
        for part, raw, off in X.blocks(batch, "text"):
            v, cut = _sets(raw, off)
            ids.append(part.column("uid").to_numpy())
            vals.append(v)
            sizes.append(np.diff(cut))
            n += len(raw)
            if n >= _HELD:
                yield np.concatenate(ids), np.concatenate(vals), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
                ids, vals, sizes, n = [], [], [], 0
    if ids:
        yield np.concatenate(ids), np.concatenate(vals), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _dealt(owner: np.ndarray, value: np.ndarray, owners: np.ndarray, parts: int, batch: int) -> list[tuple]:
    """A row for each part of the hash range: its owners, how many values each has there, and the values."""
    part = (((value & U64(0xFFFFFFFF)) * U64(parts)) >> U64(32)).astype(np.int64)
    order = np.lexsort((owner, part))
    owner, value, part = owner[order], value[order], part[order]
    cut = np.searchsorted(part, np.arange(parts + 1))
    rows = []
    for p in range(parts):
        a, b = cut[p], cut[p + 1]
        if a < b:
            first = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
            sizes = np.diff(np.append(first, b - a)).astype(np.int32)
            rows.append((p, batch, owners[owner[a:b][first]].tobytes(), sizes.tobytes(), value[a:b].tobytes()))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _SENT, strict=True)], schema=_SENT)


def _prefixes(parts: int):
    """For each block: distinct sets' prefixes in hash order, by parts.  What several sets of the block share is counted here
    (a row with negative sizes) and sent once, without an owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values, cut in _held(batches):
            name, _ = _names(values, cut)
            n = np.diff(cut)
            names, at = np.unique(name[n > 0], return_index=True)
            at = np.flatnonzero(n > 0)[at]
            n = n[at]
            p = np.minimum(n, n - -(-NUM * n // DEN) + _least_shared(n))
            owner = np.repeat(np.arange(len(at)), p)
            value = values[np.repeat(cut[:-1][at], p) + np.arange(len(owner)) - np.repeat(np.cumsum(p) - p, p)]
            order = np.argsort(value, kind="stable")
            run_ = np.cumsum(np.diff(value[order], prepend=value[order][:1]) != 0)
            many = np.bincount(run_)[run_] > 1 if len(run_) else np.zeros(0, bool)
            shared = np.zeros(len(value), bool)
            shared[order] = many
            local = np.bincount(owner[shared], minlength=len(at)).astype(np.int32)
            batch = int(X.as_long(X.mix(np.array([names.sum() if len(names) else 0], np.int64).view(U64)))[0])
            owners = np.append(names, 0)  # the last stands for tokens that are known to be shared
            once = np.unique(value[shared])
            rows = _dealt(np.concatenate([owner[~shared], np.full(len(once), len(at))]), np.concatenate([value[~shared], once]), owners, parts, batch)
            rows.append((batch % parts, batch, names.tobytes(), (-local - 1).astype(np.int32).tobytes(), b""))
            yield _batch(rows)

    return run


def _least_shared(n):
    return -(-EXTRA * n // DEN) if isinstance(n, np.ndarray) else F.ceil(F.lit(EXTRA) * n / DEN)


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    batch_ids, owners, sizes, values = [], [], [], []
    for batch in batches:
        for i in range(batch.num_rows):
            o = np.frombuffer(batch.column("owners")[i].as_py(), np.int64)
            owners.append(o)
            batch_ids.append(np.full(len(o), batch.column("batch")[i].as_py(), np.int64))
            sizes.append(np.frombuffer(batch.column("sizes")[i].as_py(), np.int32))
            values.append(np.frombuffer(batch.column("values")[i].as_py(), U64))
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return cat(batch_ids, np.int64), cat(owners, np.int64), cat(sizes, np.int32).astype(np.int64), cat(values, U64)


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batch, owner, size, value = _gathered(batches)
    known = size < 0
    per = np.where(known, 0, size)
    slot = np.repeat(np.arange(len(owner)), per)
    order = np.argsort(value, kind="stable")
    v, own, who = value[order], owner[slot[order]], slot[order]
    run_ = np.cumsum(np.diff(v, prepend=v[:1]) != 0)
    first = np.flatnonzero(np.diff(run_, prepend=-1))
    low, high = (f.reduceat(own, first) if len(first) else own for f in (np.minimum, np.maximum))
    flag = np.bincount(run_, weights=own == 0, minlength=len(first)) > 0 if len(first) else np.zeros(0, bool)
    shared = (flag | (low != high))[run_] & (own != 0) if len(first) else np.zeros(0, bool)
    counts = np.bincount(who[shared], minlength=len(owner))
    counts[known] = -size[known] - 1
    keep = np.flatnonzero(counts > 0)
    keep = keep[np.argsort(batch[keep], kind="stable")]
    first = np.flatnonzero(np.diff(batch[keep], prepend=batch[keep][:1] - 1))
    rows = [(int(batch[keep[x]]), owner[keep[x:y]].tobytes(), counts[keep[x:y]].astype(np.int32).tobytes()) for x, y in zip(first, np.append(first, len(keep))[1:], strict=True)]
    cols = list(zip(*rows, strict=True)) or [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["batch", "names", "counts"])


def _sum_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all parts summed for each set of a block; rows come block by block."""

    def summed(names: list, counts: list) -> pa.RecordBatch:
        name, at = np.unique(np.concatenate(names), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(name)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(name), pa.array(total)], names=["name", "shared"])

    at, names, counts = None, [], []
    for batch in batches:
        for i in range(batch.num_rows):
            if (now := batch.column("batch")[i].as_py()) != at:
                if names:
                    yield summed(names, counts)
                at, names, counts = now, [], []
            names.append(np.frombuffer(batch.column("names")[i].as_py(), np.int64))
            counts.append(np.frombuffer(batch.column("counts")[i].as_py(), np.int32))
    if names:
        yield summed(names, counts)


def _whole_sets(parts: int):
    """All shingles of each set by parts; those that FREQUENT sets of the block hold go straight back, and once as a mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uids, values, cut in _held(batches):
            owner = np.repeat(np.arange(len(uids)), np.diff(cut))
            order = np.argsort(values, kind="stable")
            run_ = np.cumsum(np.diff(values[order], prepend=values[order][:1]) != 0)
            often = np.zeros(len(values), bool)
            often[order] = np.bincount(run_)[run_] >= FREQUENT if len(run_) else False
            marks = np.unique(values[often])
            owners = np.append(uids, -1)
            rows = _dealt(np.concatenate([owner[~often], np.full(len(marks), len(uids))]), np.concatenate([values[~often], marks]), owners, parts, 0)
            rows += [(p, 1, *rest) for p, _, *rest in _dealt(owner[often], values[often], owners, parts, 1)]
            yield _batch(rows)

    return run


def _with_frequency(buckets: int):
    """The shingles that several sets have, with their frequency, dealt to buckets of sets: a row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back, owner, size, value = _gathered(batches)
        slot = np.repeat(np.arange(len(owner)), size)
        straight = (back == 1)[slot]
        order = np.argsort(value, kind="stable")
        order = order[~straight[order]]
        v = value[order]
        run_ = np.cumsum(np.diff(v, prepend=v[:1]) != 0)
        mark = owner[slot[order]] == -1
        df = np.full(len(value), _FREQUENT_DF, np.int64)
        if len(run_):
            flagged = np.bincount(run_, weights=mark) > 0
            df[order] = np.where(flagged, _FREQUENT_DF, np.bincount(run_))[run_]
        keep = np.flatnonzero((df >= 2) & (owner[slot] >= 0))
        who = owner[slot[keep]]
        bucket = (X.mix(who.view(U64)) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, who, keep = bucket[order], who[order], keep[order]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        rows = [(int(bucket[a]), who[a:b].tobytes(), df[keep[a:b]].astype(np.int32).tobytes(), value[keep[a:b]].tobytes()) for a, b in zip(first, np.append(first, len(bucket))[1:], strict=True)]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "cids", "dfs", "tokens"])

    return run


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set's shared shingles by (frequency, hash), and the sum of their frequencies."""
    parts: list[list] = [[], [], []]
    for batch in batches:
        for column, out, kind in zip(("cids", "dfs", "tokens"), parts, (np.int64, np.int32, np.int64), strict=True):
            out += [np.frombuffer(v.as_py(), kind) for v in batch.column(column)]
    if not parts[0]:
        return
    cid, df, token = (np.concatenate(p) for p in parts)
    order = np.lexsort((token, df, cid))
    cid, df, token = cid[order], df[order], token[order]
    first = np.flatnonzero(np.diff(cid, prepend=cid[:1] - 1))
    pairs = pa.StructArray.from_arrays([pa.array(df), pa.array(token)], names=["df", "token"])
    weight = np.add.reduceat(df.astype(float), first)
    yield pa.RecordBatch.from_arrays([pa.array(cid[first]), pa.array(weight), X.list_array(pairs, np.append(first, len(cid)))], names=["cid", "weight", "tokens"])


def _fits(n: Column, m: Column, p: Column, q: Column) -> Column:
    """Length and positional bounds: the overlap that sets of n and m shingles need fits behind positions p and q."""
    need = (n + m) * NUM
    return (DEN * n >= NUM * m) & (DEN * m >= NUM * n) & (need <= (n - p) * (NUM + DEN)) & (need <= (m - q) * (NUM + DEN))


def _links(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb) whose overlap, counted by fragments and summed, makes the similarity."""
    one = pairs.join(segments.select(F.col("cid").alias("a"), "fragment", F.col("tokens").alias("ta")), "a")
    both = one.join(segments.select(F.col("cid").alias("b"), "fragment", F.col("tokens").alias("tb")), ["b", "fragment"])
    parts = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("part"))
    total = parts.groupBy("a", "b").agg(F.sum("part").alias("overlap"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return total.where(DEN * F.col("overlap") >= NUM * (F.col("na") + F.col("nb") - F.col("overlap"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: uid, doc_id, n_shingles, class_id, group_id and component_id, the least doc_id that links reach.

    ``class_id`` names equal sets and ``group_id`` linked ones, by the number of one of their rows; null for empty sets.

    Words are runs of all but 0x20 and 0x09-0x0D with A-Z in lower case; the set is that of distinct five-word shingles, or
    the whole sequence of fewer words.  Null and wordless texts have empty sets and are linked with nothing: their
    component is their own doc_id.  Rows that repeat get a row each; null doc_ids are never the least.  Only doc_id and text
    are read.  The result is a stored table; what led to it is removed.
    """
    workers_find_package(docs.sparkSession)
    with intermediate(docs.sparkSession):
        return returned(_near_duplicates(docs), "near-duplicates")


def _near_duplicates(docs: DataFrame) -> DataFrame:
    parts = partitions_for(docs)
    rows = numbered(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    described = stored(rows.mapInArrow(X.tidy(_describe), f"uid bigint, doc_id {kind}, n bigint, name bigint, name2 bigint"), "sets")
    names = ["n", "name", "name2"]
    classes = stored(described.where("n > 0").groupBy(*names).agg(F.min("uid").alias("cid"), F.min("doc_id").alias("least")), "classes")

    # 1. classes that share enough of their hash-ordered prefix
    sent = rows.select("uid", "text").mapInArrow(X.tidy(_prefixes(parts)), _SENT_SQL).repartition(parts, "part")
    counted = sent.mapInArrow(X.tidy(_count_shared), "batch bigint, names binary, counts binary").repartition(parts, "batch").sortWithinPartitions("batch")
    shared = counted.mapInArrow(X.tidy(_sum_shared), "name bigint, shared bigint").groupBy("name").agg(F.max("shared").alias("shared"))
    hopeful = stored(classes.join(shared, "name").where(F.col("shared") >= _least_shared(F.col("n"))).select("cid", "n"), "hopeful")

    # 2. their sets in order of frequency
    texts = by_number(rows.select("uid", "text"), hopeful.select(F.col("cid").alias("uid")), "uid", "left_semi")
    tokens = texts.mapInArrow(X.tidy(_whole_sets(parts)), _SENT_SQL).repartition(parts, "part").mapInArrow(X.tidy(_with_frequency(parts)), "bucket int, cids binary, dfs binary, tokens binary")
    ordered = tokens.repartition(parts, "bucket").mapInArrow(X.tidy(_in_order), "cid bigint, weight double, tokens array<struct<df:int,token:bigint>>")
    ordered = stored(ordered.join(hopeful, "cid"), "ordered")
    length = F.col("n") - F.ceil(F.lit(NUM) * F.col("n") / DEN) + 1 - (F.col("n") - F.size("tokens"))
    prefix = ordered.withColumn("length", length.cast("int")).where("length > 0")
    prefix = prefix.select("cid", "n", (F.col("weight") / F.col("n")).alias("common"), (F.col("n") - F.size("tokens")).alias("before"), F.posexplode(F.transform(F.slice("tokens", 1, F.col("length")), lambda t: t["token"])).alias("at", "token"))
    prefix = stored(prefix.select("token", "cid", "n", "common", (F.col("before") + F.col("at")).alias("p")), "prefix")

    # 3. and 4. stars, then what is left in each bucket
    weight = F.least(F.col("t.df"), F.lit(1 << 20)).cast("bigint") * 65536 + F.shiftrightunsigned("t.token", 48)
    cuts = ordered.select(F.explode("tokens").alias("t")).agg(F.percentile_approx(weight, [i / FRAGMENTS for i in range(1, FRAGMENTS)], 1000)).first()[0] or [0] * (FRAGMENTS - 1)
    place = lambda t: F.least(t["df"], F.lit(1 << 20)).cast("bigint") * 65536 + F.shiftrightunsigned(t["token"], 48)
    bounds = [None, *cuts, None]

    def segment(i: int) -> Column:
        low, high = bounds[i], bounds[i + 1]
        inside = lambda t: (F.lit(True) if low is None else place(t) > low) & (F.lit(True) if high is None else place(t) <= high)
        return F.struct(F.lit(i).alias("fragment"), F.transform(F.filter("tokens", inside), lambda t: t["token"]).alias("tokens"))

    segments = ordered.select("cid", F.explode(F.array(*[segment(i) for i in range(FRAGMENTS)])).alias("s")).select("cid", "s.*").where(F.size("tokens") > 0)
    centres = prefix.groupBy("token").agg(F.max_by(F.struct("cid", "n", "p"), F.struct("common", "cid")).alias("c"), F.count(F.lit(1)).alias("members")).where("members > 1").select("token", "c")
    beside = prefix.join(centres, "token")
    ordered_pair = [F.least(F.col("cid"), F.col("c.cid")).alias("a"), F.greatest(F.col("cid"), F.col("c.cid")).alias("b")]
    first_is_own = F.col("cid") < F.col("c.cid")
    stars = beside.where((F.col("cid") != F.col("c.cid")) & _fits(F.col("n"), F.col("c.n"), F.col("p"), F.col("c.p")))
    stars = stars.select(*ordered_pair, F.when(first_is_own, F.col("n")).otherwise(F.col("c.n")).alias("na"), F.when(first_is_own, F.col("c.n")).otherwise(F.col("n")).alias("nb")).distinct()
    links = stored(_links(stars, segments), "links")
    of = stored(components(links), "components")
    member = lambda df, node, name: df.join(of.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))
    placed = member(beside.select("token", "cid", "n", "p", F.col("c.cid").alias("centre")), "cid", "own")
    placed = member(placed, "centre", "main")
    mixed = stored(placed.withColumn("left", F.col("own") != F.col("main")).select("token", "cid", "n", "p", "own", "left"), "mixed")
    odd = mixed.where("left").select("token").distinct()
    bucket = mixed.join(odd, "token", "left_semi")
    strong = F.col("n") * 2 * NUM <= (F.col("n") - F.col("p")) * (NUM + DEN)
    short = bucket.where(strong).select("token", *[F.col(c).alias(f"x_{c}") for c in ("cid", "n", "p", "own", "left")])
    meet = (F.col("x_own") != F.col("own")) & ((F.col("x_n") < F.col("n")) | ((F.col("x_n") == F.col("n")) & (F.col("x_cid") != F.col("cid")))) & _fits(F.col("x_n"), F.col("n"), F.col("x_p"), F.col("p"))
    rest = short.where("x_left").join(bucket, "token").where(meet).unionByName(short.where("not x_left").join(bucket.where("left"), "token").where(meet))
    own_first = F.col("x_cid") < F.col("cid")
    rest = rest.select(F.least("x_cid", "cid").alias("a"), F.greatest("x_cid", "cid").alias("b"), F.when(own_first, F.col("x_n")).otherwise(F.col("n")).alias("na"), F.when(own_first, F.col("n")).otherwise(F.col("x_n")).alias("nb")).distinct()
    more = stored(_links(rest, segments), "links")
    if more.isEmpty():
        final = of
    else:
        final = stored(components(of.select(F.col("component").alias("u"), F.col("node").alias("v")).unionByName(more)), "components")

    found = classes.join(final.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = found.groupBy("component").agg(F.min("least").alias("component_id"))
    named = found.join(least, "component").select(*names, F.col("cid").alias("class_id"), F.col("component").alias("group_id"), "component_id")
    out = described.join(named, names, "left")
    return out.select("uid", "doc_id", F.col("n").alias("n_shingles"), "class_id", "group_id", F.coalesce("component_id", "doc_id").alias("component_id"))
