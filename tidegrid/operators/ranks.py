"""Ranks and running sums over a whole table without a one-task window.

Rows are dealt by ranges of the key; each range counts itself, the counts of all ranges (a few hundred rows) are summed up and
sent back as offsets, and a window inside each range does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import written

def running(df: DataFrame, key: Column, ties: Sequence[str], sums: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Add ``rank`` (1, 2, ...) by ``key`` and ``ties``, ``total`` rows, and for each of ``sums`` its running sum and ``<name>_total``.

    Rows are dealt by ranges of (by, key, ties) and stored, so that the ranges of a group, and of equal keys, may be many.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumns({f"__{k}": v for k, v in sums.items()}).withColumn("__key", key)
    cut = written(keyed.repartitionByRange(ranges, *by, "__key", *ties).withColumn("__range", F.spark_partition_id()), "ranges")
    totals = cut.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"__{k}").alias(f"t_{k}") for k in sums])
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(*by, "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o_n"), F.sum("n").over(whole).alias("total"), *[F.coalesce(F.sum(f"t_{k}").over(before), F.lit(0)).alias(f"o_{k}") for k in sums], *[F.sum(f"t_{k}").over(whole).alias(f"{k}_total") for k in sums])
    w = Window.partitionBy(*by, "__range").orderBy("__key", *ties)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cut.join(offsets, [*by, "__range"])
    out = out.withColumn("rank", F.row_number().over(w) + F.col("o_n")).withColumns({k: F.sum(f"__{k}").over(upto) + F.col(f"o_{k}") for k in sums})
    return out.drop("__range", "__key", "o_n", *[f"__{k}" for k in sums], *[f"o_{k}" for k in sums])


def average_precision(df: DataFrame, target: str, probability: str, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """pr_auc of each group: precision at each positive, in order of falling probability; 0 without positives."""
    r = running(df, -F.col(probability), ties, {"hits": F.col(target).cast("bigint")}, by)
    positives = F.sum(F.col(target).cast("bigint"))
    return r.groupBy(*by).agg((F.when(positives > 0, F.sum(F.col("hits") / F.col("rank") * F.col(target)) / positives).otherwise(0.0)).alias("pr_auc"))


def f1_threshold(df: DataFrame, target: str, probability: str) -> DataFrame:
    """The probability at which calling a flip gives the best F1; of equals the lowest.  One row."""
    at = df.groupBy(F.col(probability).alias("threshold")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("p"))
    r = running(at, -F.col("threshold"), [], {"called": F.col("n"), "hits": F.col("p")})
    f1 = F.when(F.col("called") + F.col("hits_total") > 0, 2 * F.col("hits") / (F.col("called") + F.col("hits_total"))).otherwise(0.0)
    return r.select("threshold", f1.alias("f1")).agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b")).select("b.*")


def terciles(df: DataFrame, value: str, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``tercile`` 1 to 3 by rank in each group; what is left over goes to the first groups."""
    r = running(df, F.col(value), ties, {}, by)
    size, more = F.floor(F.col("total") / 3), F.col("total") % 3
    first = size + (more > 0).cast("int")
    second = first + size + (more > 1).cast("int")
    return r.withColumn("tercile", F.when(F.col("rank") <= first, 1).when(F.col("rank") <= second, 2).otherwise(3)).drop("rank", "total")
