"""Histogram boosting: against a plain version, row by row, and its cases of masked values and labels."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidegrid.operators import boosting as B
from tidegrid.operators import forecast as M

SCHEMA = "id int, a double, b double, c double, y double, flip double, mask double"


def rows(n, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.uniform(-5, 5), float(r.randrange(6)), r.gauss(0, 1)
        no = r.random() < 0.2
        y = (30 if no else 20 if a > 1 else -3) + 4 * b + c
        out.append((i, None if no else a, b, float("nan") if i % 11 == 0 else c, y, float(a + b > 4), float(i % 7 != 0)))
    return out


def edges(values, bins):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    distinct = sorted(set(known))
    if len(distinct) <= bins:
        return [(x + y) / 2 for x, y in zip(distinct, distinct[1:], strict=False)]
    return sorted({known[k * len(known) // bins] for k in range(1, bins)})


def plain_boost(data, ys, classes, rounds, step, depth, bins, least, penalty):
    """Scores by the definition: every cut of every node tried by going through its rows."""
    width = len(data[0])
    cuts = [edges([x[f] for x in data], bins) for f in range(width)]
    missing = lambda v: v is None or math.isnan(v)
    own = [i for i, y in enumerate(ys) if y is not None]
    mean = sum(ys[i] for i in own) / len(own)
    score = [math.log(mean / (1 - mean)) if classes else mean] * len(data)

    def slopes(i):
        if not classes:
            return score[i] - ys[i], 1.0
        p = 1 / (1 + math.exp(-score[i]))
        return p - ys[i], p * (1 - p)

    def grow(inside, everyone, level, g, h, add):
        total = (sum(g[i] for i in inside), sum(h[i] for i in inside))
        best = None
        for f in range(width if level < depth else 0):
            none = [i for i in inside if missing(data[i][f])]
            for edge in cuts[f]:
                left = [i for i in inside if not missing(data[i][f]) and data[i][f] <= edge]
                for side in (True, False):
                    a = left + none if side else left
                    if not none and side != (2 * len(left) >= len(inside)):
                        continue
                    if min(len(a), len(inside) - len(a)) < least:
                        continue
                    s, t = sum(g[i] for i in a), sum(h[i] for i in a)
                    u, v = total[0] - s, total[1] - t
                    gain = s * s / (t + penalty) + u * u / (v + penalty) - total[0] ** 2 / (total[1] + penalty)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-7 * abs(best[0])):
                        best = gain, f, edge, side
        if best is None:
            if level:
                for i in everyone:
                    add[i] = -step * total[0] / (total[1] + penalty)
            return
        _, f, edge, side = best
        goes = lambda i: side if missing(data[i][f]) else data[i][f] <= edge
        for want in (True, False):
            grow([i for i in inside if goes(i) == want], [i for i in everyone if goes(i) == want], level + 1, g, h, add)

    for _ in range(rounds):
        g, h = zip(*[slopes(i) if ys[i] is not None else (0.0, 0.0) for i in range(len(data))], strict=True)
        add = [0.0] * len(data)
        grow(own, list(range(len(data))), 0, g, h, add)
        score = [s + a for s, a in zip(score, add, strict=True)]
    return [1 / (1 + math.exp(-s)) for s in score] if classes else score


def test_equals_the_plain_version(spark):
    data = rows(260)
    df = spark.createDataFrame(data, SCHEMA)
    model = B.fit(df, ["a", "b", "c"], [("y", False, None), ("flip", True, "mask")], rounds=4, step=0.3, depth=3, bins=9, leaf_rows=8)
    got = {r["id"]: (r["v"], r["p"]) for r in model.apply(df, ["v", "p"]).collect()}
    x = [r[1:4] for r in data]
    value = plain_boost(x, [r[4] for r in data], False, 4, 0.3, 3, 9, 8, 1.0)
    flips = plain_boost(x, [r[5] if r[6] else None for r in data], True, 4, 0.3, 3, 9, 8, 1.0)
    for i in range(len(data)):
        assert abs(got[i][0] - value[i]) < 1e-5 and abs(got[i][1] - flips[i]) < 1e-6, (i, got[i], value[i], flips[i])


def test_same_fit_however_rows_lie(spark, monkeypatch):
    df = spark.createDataFrame(rows(900, 5), SCHEMA)
    fit = lambda d: B.fit(d, ["a", "b", "c"], [("y", False, None), ("flip", True, "mask")], rounds=21, depth=2)  # noqa: E731  # scores are stored once
    one = fit(df.repartition(1))
    monkeypatch.setattr(B, "TASK_ROWS", 200)
    two = fit(df.repartition(7, "id"))  # four tasks, whose histograms are grouped
    for a, b in zip(one.labels, two.labels, strict=True):
        assert a.base == b.base and len(a.trees) == len(b.trees) == 21
        for s, t in zip(a.trees, b.trees, strict=True):
            assert all(np.array_equal(getattr(s, f), getattr(t, f)) for f in ("feature", "cut", "masked_left", "value"))


def test_masked_rows_have_their_own_side_and_the_fit_is_close(spark):
    df = spark.createDataFrame(rows(2000, 8), SCHEMA)
    out = M.fit_trees(df.withColumnsRenamed({"y": "target_next", "flip": "flip_target", "mask": "flip_mask"}), ["a", "b", "c"], rounds=30, step=0.2)
    scored = out(df).agg(F.avg(F.abs(F.col("tree_value") - F.col("y"))).alias("mae"), F.avg(F.pow(F.col("tree_flip") - F.col("flip"), 2)).alias("brier"), F.avg(F.when(F.col("a").isNull(), F.abs(F.col("tree_value") - F.col("y")))).alias("masked"))
    r = scored.first()
    spread = df.select(F.stddev_pop("y")).first()[0]
    assert r["mae"] < 0.3 * spread and r["masked"] < 0.5 * spread and r["brier"] < 0.08, (r, spread)


def test_labels_without_anything_to_fit(spark):
    some = spark.createDataFrame([(i, float(i), None, 1.0, 5.0, 1.0, 1.0) for i in range(50)], SCHEMA)
    model = B.fit(some, ["a", "b"], [("y", False, None), ("flip", True, "mask"), ("flip", True, "b")], rounds=3)
    assert {tuple(r) for r in model.apply(some, ["v", "p", "q"]).select("v", "p", "q").collect()} == {(5.0, 1.0, 0.0)}
    none = spark.createDataFrame([], SCHEMA)
    empty = B.fit(none, ["a", "b"], [("y", False, None)], rounds=3)
    assert empty.apply(none, ["v"]).collect() == [] and [r["v"] for r in empty.apply(some, ["v"]).collect()] == [0.0] * 50
    wild = spark.createDataFrame([(i, float(i), 1.0, 1.0, None if i % 3 == 0 else float("inf") if i % 3 == 1 else float(i > 50), 0.0, 0.0) for i in range(150)], SCHEMA)
    fitted = B.fit(wild, ["a", "b"], [("y", False, None)], rounds=30, step=0.3)
    got = fitted.apply(wild.withColumn("__x", F.lit(1)), ["v"]).where("v is not null and not isnan(v)")
    assert got.count() == 150 and got.where("id > 60").agg(F.min("v")).first()[0] > 0.8
