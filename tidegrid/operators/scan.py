"""Prefix scans over long series without a window on the series.

Chunks of a series are numbered; up to 64 neighbours form a block, 64 blocks a larger one.  Blocks are combined upwards, and what holds before
each is handed down again, so that a task has the 64 elements of one block, however long the series is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import written

_BITS = 6
Then = Callable[[Column, Column], Column]


def fold(elements: Column, then: Then, kind: str) -> Column:
    """Elements combined in order; null is the empty stretch."""
    return F.aggregate(elements, F.lit(None).cast(kind), then)


def before_each(elements: DataFrame, by: Sequence[str], number: str, element: str, then: Then) -> DataFrame:
    """(by, number, seed): what the elements of lower number amount to, null before the first.  One row a number, in (by, number, element)."""
    kind = dict(elements.dtypes)[element]
    level = written(elements.select(*by, F.col(number).cast("bigint").alias("__n"), F.col(element).alias("__e")), "scan")
    lo, hi = (x or 0 for x in level.agg(F.min("__n"), F.max("__n")).first())
    # up to 64 elements in order; blocks are counted from the least number
    blocks = level.groupBy(*by, F.shiftright(F.col("__n") - F.lit(lo), _BITS).alias("__up")).agg(F.array_sort(F.collect_list(F.struct("__n", "__e"))).alias("__xs"))
    items = F.transform("__xs", lambda x: x["__e"])
    if hi - lo < 1 << _BITS:
        seeded = blocks.withColumn("__s", F.lit(None).cast(kind))
    else:
        blocks = written(blocks, "scan-blocks")
        above = before_each(blocks.select(*by, "__up", fold(items, then, kind).alias("__whole")), by, "__up", "__whole", then)
        seeded = blocks.join(above.select(*by, "__up", F.col("seed").alias("__s")), [*by, "__up"])
    out = seeded.select(*by, F.posexplode("__xs").alias("__i", "__x"), items.alias("__all"), "__s")
    seed = then(F.col("__s"), fold(F.slice("__all", F.lit(1), F.col("__i")), then, kind)).cast(kind)
    return out.select(*by, F.col("__x.__n").alias(number), F.when((F.col("__i") > 0) | F.col("__s").isNotNull(), seed).alias("seed"))


def latest(a: Column, b: Column) -> Column:
    """The later of two: null is nothing."""
    return F.coalesce(b, a)
