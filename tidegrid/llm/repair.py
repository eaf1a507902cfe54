"""Repair of conversation structure: the cheapest edits that make the roles a well-formed exchange, by a checkpointed DP.

Turns are kept, given another role, deleted or inserted until the roles' initials match ``(s?(ua)+)?``: four states, of which the next
role follows.  Backward cost vectors (the least cost from each state to a well-formed end) are stored only at every
sqrt(n)-th turn; the walk forward recomputes one stretch at a time and takes, of the tight edits, the one that is least in ASCII.

Conversations of any length: turns are dealt by ranges of (conversation, turn), so that a long conversation is cut into blocks.
A block's costs between states are a 4 x 4 matrix; the matrices of a conversation give the vector at the end of each
block, which is an outer checkpoint, and walks from all four states give the state that each block begins in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as X
from .common import intermediate, returned, stored, workers_find_package

#: Costs of deleting, inserting, giving another role, and of a truncated turn that stays.
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
FAR = 1 << 60
#: States: nothing yet, after the system turn, after a user's, after an assistant's.  What comes next, and the state after it.
_NEXT = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
_SPACE = " \t\n\v\f\r"
#: What a turn is: its first fault, if any.
FINE, TRUNCATED, GONE = 0, 1, 2
Vector = tuple[int, int, int, int]
Turn = tuple[str, int, int]  #: initial, fault, copies


def _inserted(b: list[int]) -> Vector:
    """Least costs when turns may be inserted before whatever ``b`` is the cost of."""
    two, three = min(b[2], INSERT + b[3]), min(b[3], INSERT + b[2])
    return min(b[0], INSERT + two), min(b[1], INSERT + two), two, three


END = _inserted([0, FAR, FAR, 0])


def _kept(state: int, initial: str) -> int | None:
    """The state after a turn that is kept, if it may stand there."""
    if initial == "s":
        return 1 if state == 0 else None
    return _NEXT[state][0] if initial == _NEXT[state][1][0] else None


def _back(turn: Turn, after: Vector) -> Vector:
    """The costs before a turn from those after it; copies beyond the first are deleted."""
    initial, fault, n = turn
    more = DELETE * (n - 1)
    b = [min(FAR, DELETE + more + x) for x in after]
    if fault != GONE:
        extra = more + (CUT if fault == TRUNCATED else 0)
        for s in range(4):
            b[s] = min(b[s], REROLE + extra + after[_NEXT[s][0]])
            t = _kept(s, initial)
            if t is not None:
                b[s] = min(b[s], extra + after[t])
    return _inserted(b)


def least_cost(turns: list[Turn], end: Vector = END) -> Vector:
    for t in reversed(turns):
        end = _back(t, end)
    return end


def walk(turns: list[Turn], start: int, end: Vector = END, last: bool = True) -> tuple[list[tuple[str, str | None]], int]:
    """The tight edits that are least in ASCII, as (letter, new role), and the state they lead to; ``last`` if nothing follows.

    Vectors are held at every k-th turn, k = sqrt(n), and for the k turns that are walked.
    """
    n = len(turns)
    k = isqrt(n) + 1
    marks, b = {n: end}, end
    for i in range(n - 1, -1, -1):
        b = _back(turns[i], b)
        if i % k == 0:
            marks[i] = b
    edits: list[tuple[str, str | None]] = []
    state = start
    for lo in range(0, n, k):
        hi = min(n, lo + k)
        own = [marks[hi]]
        for i in range(hi - 1, lo - 1, -1):
            own.append(_back(turns[i], own[-1]))
        own.reverse()
        for i in range(lo, hi):
            initial, fault, copies = turns[i]
            more = DELETE * (copies - 1)
            here, after = own[i - lo], own[i - lo + 1]
            while True:
                left, (to, role) = here[state], _NEXT[state]
                extra, keep = more + (CUT if fault == TRUNCATED else 0), _kept(state, initial)
                if left == DELETE + more + after[state]:
                    edits.append(("D", None))
                elif left == INSERT + here[to]:
                    edits.append(("I", role))
                    state = to
                    continue
                elif fault != GONE and keep is not None and left == extra + after[keep]:
                    edits.append(("K", None))
                    state = keep
                else:
                    edits.append(("R", role))
                    state = to
                break
            edits += [("D", None)] * (copies - 1)
    while last and END[state]:
        edits.append(("I", _NEXT[state][1]))
        state = _NEXT[state][0]
    return edits, state


def _legal(a: str, b: str) -> bool:
    return (a + b) in ("su", "ua", "au")


def _turns(items: list[dict]) -> list[Turn]:
    return [(x["initial"], x["fault"], x["n"]) for x in items]


def _matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least costs of a block from each state to each, 16 numbers, row by row."""
    for batch in batches:
        out = []
        for items in batch.column("items").to_pylist():
            ends = [least_cost(_turns(items), tuple(0 if t == s else FAR for t in range(4))) for s in range(4)]
            out.append([ends[t][s] for s in range(4) for t in range(4)])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "matrix"])


def _afters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the blocks of a conversation, in order: the vector at each one's end."""
    for batch in batches:
        conv, block, after, last = [], [], [], []
        for i, blocks in enumerate(batch.column("blocks").to_pylist()):
            b = END
            for j, x in enumerate(reversed(blocks)):
                conv.append(i)
                block.append(x["block"])
                after.append(list(b))
                last.append(j == 0)
                m = x["matrix"]
                b = tuple(min(FAR, *(m[4 * s + t] + b[t] for t in range(4))) for s in range(4))
        yield pa.RecordBatch.from_arrays([batch.column("conv").take(pa.array(conv, pa.int64())), pa.array(block, pa.int32()), pa.array(after, pa.list_(pa.int64())), pa.array(last, pa.bool_())], names=["conv", "block", "after", "last"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that a block leads to from each state."""
    for batch in batches:
        out = []
        for items, after, last in zip(*(batch.column(c).to_pylist() for c in ("items", "after", "last")), strict=True):
            out.append([walk(_turns(items), s, tuple(after), last)[1] for s in range(4)])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "block", "after", "last")), pa.array(out, pa.list_(pa.int32()))], names=["conv", "block", "after", "last", "ends"])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the blocks of a conversation, in order: the state that each begins in."""
    for batch in batches:
        conv, rows = [], []
        for i, blocks in enumerate(batch.column("blocks").to_pylist()):
            state = 0
            for x in blocks:
                conv.append(i)
                rows.append((x["block"], state, x["after"], x["last"]))
                state = x["ends"][state]
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        types = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("conv").take(pa.array(conv, pa.int64())), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], names=["conv", "block", "start", "after", "last"])


_PIECE = "audit string, repaired string, repaired_sha256 string, illegal bigint, cost bigint, first string, final string"
_TYPES = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
_COST = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of a block's turns, its repaired text (null without a turn), and the digest if the block is a whole conversation."""
    for batch in batches:
        rows = []
        for items, seed in zip(batch.column("items").to_pylist(), batch.column("seed").to_pylist(), strict=True):
            turns = _turns(items)
            edits, _ = walk(turns, seed["start"], tuple(seed["after"]), seed["last"]) if seed else walk(turns, 0)
            lines, cost = [], 0
            own = (x for x in items for _ in range(x["n"]))
            for letter, role in edits:
                cost += _COST[letter]
                if letter == "I":
                    lines.append(f"{role}:")
                    continue
                x = next(own)
                if letter != "D":
                    cost += CUT * (x["fault"] == TRUNCATED)
                    lines.append(f"{role or x['role']}:{x['text']}")
            text = "\n".join(lines) if lines else None
            bad = sum(n - 1 for _, _, n in turns) + sum(not _legal(a[0], b[0]) for a, b in zip(turns, turns[1:], strict=False))
            whole = None if seed else hashlib.sha256((text or "").encode()).hexdigest()
            rows.append(("".join(e for e, _ in edits), text, whole, bad, cost, turns[0][0], turns[-1][0]))
        cols = list(zip(*rows, strict=True)) or [[]] * len(_TYPES)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), *(pa.array(list(c), t) for c, t in zip(cols, _TYPES, strict=True))], names=["conv", "block", "audit", "repaired", "repaired_sha256", "illegal", "cost", "first", "final"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of conversation and block, one at a time: audits joined, texts only hashed."""
    conv, audit, digest, illegal, cost, before, any_text = None, [], hashlib.sha256(), 0, 0, None, False

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([conv, pa.array(["".join(audit)]), pa.array([digest.hexdigest()]), pa.array([illegal], pa.int64()), pa.array([cost], pa.int64())], names=["conv", "audit", "repaired_sha256", "illegal", "cost"])

    for batch in batches:
        for i in range(batch.num_rows):
            own = batch.column("conv").slice(i, 1)
            x = {c: batch.column(c)[i].as_py() for c in ("audit", "repaired", "illegal", "cost", "first", "final")}
            if conv is None or own.to_pylist() != conv.to_pylist():
                if conv is not None:
                    yield out()
                conv, audit, digest, illegal, cost, before, any_text = own, [], hashlib.sha256(), 0, 0, None, False
            audit.append(x["audit"])
            cost += x["cost"]
            illegal += x["illegal"] + (before is not None and not _legal(before, x["first"]))
            before = x["final"]
            if x["repaired"] is not None:
                digest.update((("\n" if any_text else "") + x["repaired"]).encode())
                any_text = True
    if conv is not None:
        yield out()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and n, the copies of each row, after the damage that crc32 of ``conv_id:turn`` modulo 20 deals.

    0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes its role user.  A null is one blank, but as
    conversation or turn it stays null.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("n"), kind.alias("kind"))
    return rows.where("kind <> 0").drop("kind")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _by_block(turns: DataFrame, *columns: str) -> DataFrame:
    """A row for each block of a conversation, its turns in order: no more rows in one than a range holds."""
    return turns.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("pos", *columns))).alias("items"))


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text and, if there, n copies): gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Turns are taken by turn, nulls first, ties by role and text, equal rows one after another.  Null roles and texts are one blank; a null conv_id is a
    conversation like any other; other columns are not read.  A conversation that no row has isn't there.  Equal rows are
    counted before they are dealt, so that however many there are they are one; other rows of a conversation are dealt by
    ranges.  What comes to one task of a long conversation is its letters and a digest of its text, block after block.
    """
    spark = rows.sparkSession
    workers_find_package(spark)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copies = F.col("n").cast("bigint") if "n" in rows.columns else F.lit(1).cast("bigint")
    with intermediate(spark):
        lines = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"), blank("role"), blank("text"), copies.alias("n")).groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
        end = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
        lines = lines.withColumns({"blank": end == "", "cut": ~end.isin(".", "!", "?"), "initial": F.substring("role", 1, 1)})
        dealt = lines.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv", "turn", "role", "text")
        number = F.monotonically_increasing_id()
        turns = stored(dealt.withColumns({"block": F.shiftright(number, 33).cast("int"), "pos": number.bitwiseAND((1 << 33) - 1), "digest": F.when(~F.col("blank"), F.sha2("text", 256))}), "turns")
        # (role, text) that a conversation has at more than one turn, and the first of these
        place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
        again = turns.where("not blank").groupBy("conv", "role", "digest").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "at")
        seen = _same(F.col("conv"), F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
        later = F.coalesce(F.col("at") != place, F.lit(False))
        told = turns.join(again, seen, "left").withColumn("later", later)
        fault = F.when(F.col("blank") | F.col("later"), GONE).when(F.col("cut"), TRUNCATED).otherwise(FINE)
        told = stored(told.select("conv", "turn", "block", "pos", "role", "text", "n", "blank", "later", "cut", "initial", fault.alias("fault")), "told")

        kind = dict(told.dtypes)["conv"]
        light = told.select("conv", "block", "pos", "initial", "fault", "n")
        # conversations in several blocks: two for each block at most
        wide = stored(light.groupBy(F.col("conv").alias("c")).agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi").select("c"), "wide")
        blocks = _by_block(light.join(wide, _same(F.col("conv"), F.col("c")), "left_semi"), "initial", "fault", "n")
        items = dict(blocks.dtypes)["items"]
        costs = stored(blocks.mapInArrow(_matrix, f"conv {kind}, block int, items {items}, matrix array<bigint>"), "costs")
        in_order = lambda df, *c: df.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", *c))).alias("blocks"))
        afters = in_order(costs, "matrix").mapInArrow(_afters, f"conv {kind}, block int, after array<bigint>, last boolean").select(F.col("conv").alias("c"), F.col("block").alias("b"), "after", "last")
        known = costs.join(afters, _same(F.col("conv"), F.col("c")) & (F.col("block") == F.col("b")))
        ends = known.select("conv", "block", "items", "after", "last").mapInArrow(_ends, f"conv {kind}, block int, after array<bigint>, last boolean, ends array<int>")
        starts = in_order(ends, "after", "last", "ends").mapInArrow(_starts, f"conv {kind}, block int, start int, after array<bigint>, last boolean")
        seeds = stored(starts.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.struct("start", "after", "last").alias("seed")), "seeds")

        whole = _by_block(told.select("conv", "block", "pos", "role", "text", "initial", "fault", "n"), "role", "text", "initial", "fault", "n")
        seeded = whole.join(seeds, _same(F.col("conv"), F.col("c")) & (F.col("block") == F.col("b")), "left").select("conv", "block", "items", "seed")
        pieces = stored(seeded.mapInArrow(X.tidy(_edited), f"conv {kind}, block int, {_PIECE}"), "pieces")
        long = pieces.where("repaired_sha256 is null").repartition("conv").sortWithinPartitions("conv", "block")
        made = long.mapInArrow(_joined, f"conv {kind}, audit string, repaired_sha256 string, illegal bigint, cost bigint")
        edits = pieces.where("repaired_sha256 is not null").select("conv", "audit", "repaired_sha256", "illegal", "cost").unionByName(made)

        count = lambda c: F.sum(c).cast("bigint")
        own = told.groupBy("conv").agg(
            (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"), count(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
            count(F.when(~F.col("blank"), F.col("n") - 1 + F.col("later").cast("bigint")).otherwise(0)).alias("duplicate"), count((F.col("fault") == TRUNCATED).cast("bigint")).alias("truncated"),
        ).withColumnRenamed("conv", "c")
        both = edits.join(own, _same(F.col("conv"), F.col("c")))
        return returned(both.select(F.col("conv").alias("conv_id"), F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"), "repaired")
