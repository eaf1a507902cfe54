"""Isotonic calibration as a table: fitted by ranges whose blocks merge, applied by a lookup of ranges.

Pooling adjacent violators gives the same blocks in whatever order neighbours are pooled.  So stretches of probabilities are pooled each
in its task, and then stretches that lie half a stretch further, until two rounds in a row pool nothing.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import workers_find_package, written
from .ranks import f1_threshold, running
from .scan import before_each, latest

#: Blocks of a stretch, which one task has in memory.
STRETCH = 1 << 16
#: Parts of [0, 1] that probabilities are looked up in.
_PARTS = 4096
_BLOCK = "lo double, hi double, n bigint, s bigint"


def _pooled(pdf: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring blocks whose means don't rise become one."""
    out: list[list] = []
    for lo, hi, n, s in pdf.sort_values("lo")[["lo", "hi", "n", "s"]].itertuples(index=False, name=None):
        out.append([lo, hi, n, s])
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            _, hi, n, s = out.pop()
            out[-1][1:] = [hi, out[-1][2] + n, out[-1][3] + s]
    return pd.DataFrame(out, columns=["lo", "hi", "n", "s"])


def pool_adjacent(blocks: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Blocks (lo, hi, n, s) in order of lo, pooled until their means s / n rise."""
    workers_find_package(blocks.sparkSession)
    now, offset, quiet = written(blocks.select("lo", "hi", "n", "s"), "pooled"), 0, 0
    count = now.count()
    while quiet < 2:
        alone = count <= stretch
        ranked = now.withColumn("at", F.lit(0)) if alone else running(now, F.col("lo"), [], {}).withColumn("at", F.floor((F.col("rank") - 1 + offset) / stretch))
        now = written(ranked.groupBy("at").applyInPandas(_pooled, _BLOCK), "pooled")
        left = now.count()
        quiet = 2 if alone else quiet + 1 if left == count else 0
        count, offset = left, stretch // 2 - offset
    return now


def isotonic_fit(df: DataFrame, probability: str = "raw", target: str = "flip_target", stretch: int = STRETCH) -> tuple[DataFrame, float]:
    """The calibration as a stored table (lo, hi, y, next_lo, next_y: between hi and next_lo it is linear), and the F1 decision threshold.

    Rows of one class give a flat one, no rows 0; with either the threshold is 0.5.
    """
    spark = df.sparkSession
    same = df.groupBy(F.col(probability).cast("double").alias("lo")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("s"))
    same = written(same.withColumn("hi", F.col("lo")), "probabilities")
    n, positives = same.agg(F.sum("n"), F.sum("s")).first()
    flat = "lo double, hi double, y double, next_lo double, next_y double"
    if not n or positives in (0, n):
        return spark.createDataFrame([(0.0, 1.0, float(bool(n and positives)), None, None)], flat), 0.5
    blocks = running(pool_adjacent(same, stretch), F.col("lo"), [], {}).select("lo", "hi", (F.col("s") / F.col("n")).alias("y"), "rank")
    after = blocks.select((F.col("rank") - 1).alias("rank"), F.col("lo").alias("next_lo"), F.col("y").alias("next_y"))
    model = written(blocks.join(after, "rank", "left").select("lo", "hi", "y", "next_lo", "next_y"), "isotonic")
    return model, float(f1_threshold(calibrate(df, model, probability), target, "calibrated").first()["threshold"])


def _value(p: Column, block: Column, first: Column) -> Column:
    """The block's value up to its end, on the line to the next block beyond it; below all blocks the first one's."""
    between = block["y"] + (block["next_y"] - block["y"]) * (p - block["hi"]) / (block["next_lo"] - block["hi"])
    raw = F.when(block.isNull(), first).when((p <= block["hi"]) | block["next_lo"].isNull(), block["y"]).otherwise(between)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw))


def calibrate(df: DataFrame, model: DataFrame, probability: str = "raw", out: str = "calibrated") -> DataFrame:
    """Add the calibrated probability, null for null.

    Each distinct probability finds its block in its part of [0, 1]; what a part begins with is carried over from the parts before it.  So neither the
    model nor the rows are in one place, however many there are of one probability.
    """
    p = F.col(probability).cast("double")
    part = lambda c: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)) * _PARTS)
    block = F.struct("lo", "hi", "y", "next_lo", "next_y")
    marks = model.select(F.col("lo").alias("__p"), F.lit(0).alias("kind"), block.alias("b"))
    asks = df.where(p.isNotNull()).select(p.alias("__p")).distinct().select("__p", F.lit(1).alias("kind"), F.lit(None).cast(dict(marks.dtypes)["b"]).alias("b"))
    both = marks.unionByName(asks).withColumn("part", part(F.col("__p")))
    ends = marks.withColumn("part", part(F.col("__p"))).groupBy("part").agg(F.max_by("b", "__p").alias("e"))
    every = both.select("part").distinct().join(ends, "part", "left")
    carried = before_each(every, (), "part", "e", latest)
    upto = Window.partitionBy("part").orderBy("__p", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.lit(model.agg(F.min_by("y", "lo")).first()[0])
    found = both.withColumn("own", F.last("b", True).over(upto)).where("kind = 1").join(carried, "part", "left")
    values = found.select("__p", _value(F.col("__p"), F.coalesce("own", "seed"), least).alias(out))
    return df.withColumn("__p", p).join(values, "__p", "left").drop("__p")
