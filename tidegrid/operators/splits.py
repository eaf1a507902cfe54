"""Purged chronological splits."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTIONS = ("train", "validation", "calibration", "test")


def _bounds(df: DataFrame, time: str) -> tuple[int, int, int]:
    """First and last time and the least distance between neighbours, in seconds.  Neighbours are found inside days and across them."""
    t = df.select(F.unix_seconds(time).alias("t")).distinct().withColumn("d", F.floor(F.col("t") / 86400))
    inside = t.withColumn("gap", F.lead("t").over(Window.partitionBy("d").orderBy("t")) - F.col("t"))
    days = inside.groupBy("d").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.min("gap").alias("gap"))
    across = F.lead("lo").over(Window.orderBy("d")) - F.col("hi")  # a row for each day
    r = days.withColumn("across", across).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.least(F.min("gap"), F.min("across")).alias("step")).first()
    if r["lo"] is None:
        raise ValueError("no times to split")
    return r["lo"], r["hi"], r["step"] or 60


def _label(t: Column, ranges: dict[str, tuple[int, int]]) -> Column:
    out = F.lit(None).cast("string")
    for name, (lo, hi) in ranges.items():
        out = F.when((t >= lo) & (t < hi), name).otherwise(out)
    return out


def latest_ranges(lo: int, hi: int, step: int, gap: timedelta, evaluation: timedelta) -> dict[str, tuple[int, int]]:
    g, e = int(gap.total_seconds()), int(evaluation.total_seconds())
    out, end = {}, hi + step
    for name in reversed(SECTIONS[1:]):
        out[name] = (end - e, end)
        end -= e + g
    return {"train": (lo, end), **dict(reversed(out.items()))}


def latest_purged_split(df: DataFrame, time: str = "cutoff", gap: timedelta = timedelta(days=1), evaluation: timedelta = timedelta(days=14), initial: timedelta = timedelta(days=60)) -> DataFrame:
    """Add ``split``; null in the purged gaps.  The test section ends with the latest row."""
    lo, hi, step = _bounds(df, time)
    ranges = latest_ranges(lo, hi, step, gap, evaluation)
    out = df.withColumn("split", _label(F.unix_seconds(time), ranges))
    found = {r["split"]: r for r in out.where("split is not null").groupBy("split").agg(F.max(F.unix_seconds(time)).alias("hi")).collect()}
    if set(found) != set(SECTIONS) or found["train"]["hi"] - lo + step < initial.total_seconds():
        raise ValueError("the rows cannot form the requested split")
    return out


def fold_table(lo: int, folds: int, gap: timedelta, evaluation: timedelta, initial: timedelta) -> list[tuple[int, str, int, int]]:
    g, e, origin, out = int(gap.total_seconds()), int(evaluation.total_seconds()), lo + int(initial.total_seconds()), []
    for fold in range(folds):
        out.append((fold, "train", lo, origin))
        at = origin
        for name in SECTIONS[1:]:
            out.append((fold, name, at + g, at + g + e))
            at += g + e
        origin = at
    return out


def walk_forward(df: DataFrame, folds: int, time: str = "cutoff", gap: timedelta = timedelta(days=1), evaluation: timedelta = timedelta(days=14), initial: timedelta = timedelta(days=60)) -> DataFrame:
    """A row for each fold and section that a row is in; training expands.  A section without rows is an error."""
    lo, _, _ = _bounds(df, time)
    table = fold_table(lo, folds, gap, evaluation, initial)
    # four ranges a fold: an array in the plan, not a join
    ranges = F.array(*[F.struct(F.lit(f).alias("fold"), F.lit(s).alias("split"), F.lit(a).alias("lo"), F.lit(b).alias("hi")) for f, s, a, b in table])
    t = F.unix_seconds(time)
    out = df.withColumn("__r", F.explode(F.filter(ranges, lambda r: (t >= r["lo"]) & (t < r["hi"])))).select("*", "__r.fold", "__r.split").drop("__r")
    if out.select("fold", "split").distinct().count() < len(table):
        raise ValueError("the rows cannot form the requested folds")
    return out


def split_sections(df: DataFrame, time: str = "cutoff") -> DataFrame:
    return df.where("split is not null").groupBy("split").agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("rows"))


def validate_split(df: DataFrame, time: str = "cutoff", gap: timedelta = timedelta(days=1)) -> None:
    """Sections must all exist, in order, with the gap between them."""
    have = {r["split"]: r for r in split_sections(df, time).collect()}  # four rows
    for a, b in zip(SECTIONS, SECTIONS[1:], strict=False):
        if a not in have or b not in have:
            raise ValueError(f"the split lacks {a} or {b}")
        if have[b]["first"] <= have[a]["last"]:
            raise ValueError("sections must be chronological and disjoint")
        if have[b]["first"] - have[a]["last"] < gap:
            raise ValueError("the split lacks the required gap")
