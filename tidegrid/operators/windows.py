"""Window features over a dense grid: hysteresis, ages, rolling statistics.

``part`` is what a window is partitioned by: a series, or a request's view of one.  A complete window has all its n steps
observed, else its value is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schemas import Registry
from ..functions.scalars import steps_between
from . import stretches
from .scan import before_each


def sign_of(value: Column, deadband: float) -> Column:
    """1, -1 or null inside the deadband."""
    return F.when(value > deadband, 1).when(value < -deadband, -1)


def transitions(df: DataFrame, part: Sequence[str], value: str, deadband: float) -> DataFrame:
    """Rows outside the deadband whose sign differs from that of the one before (0 before the first)."""
    w = Window.partitionBy(*part).orderBy("timestamp")
    signs = df.withColumn("sign", sign_of(F.col(value), deadband)).where("sign is not null")
    return signs.withColumn("previous_sign", F.lag("sign", 1, 0).over(w)).where("sign <> previous_sign")


def states(df: DataFrame, part: Sequence[str], value: str, deadband: float, step_seconds: int = 60, seeded: bool = False) -> DataFrame:
    """Add state_sign, state_since, state_duration and age (steps).

    With ``seeded``, columns seed_sign, seed_since and seed_last carry what held before the partition's first row.
    """
    w = Window.partitionBy(*part).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seed = lambda name, kind: F.col(name) if seeded else F.lit(None).cast(kind)
    out = df.withColumn("__raw", sign_of(F.col(value), deadband))
    out = out.withColumn("state_sign", F.coalesce(F.last("__raw", True).over(w), seed("seed_sign", "int")))
    before = F.coalesce(F.lag("state_sign").over(Window.partitionBy(*part).orderBy("timestamp")), seed("seed_sign", "int"))
    out = out.withColumn("__changed", F.col("state_sign").isNotNull() & ~F.col("state_sign").eqNullSafe(before))
    out = out.withColumn("state_since", F.coalesce(F.last(F.when(F.col("__changed"), F.col("timestamp")), True).over(w), seed("seed_since", "timestamp")))
    seen = F.coalesce(F.last(F.when(F.col(value).isNotNull(), F.col("timestamp")), True).over(w), seed("seed_last", "timestamp"))
    out = out.withColumn("last_observed_at", seen)
    out = out.withColumn("state_duration", F.when(F.col("state_sign").isNotNull(), steps_between(F.col("state_since"), F.col("timestamp"), step_seconds)))
    return out.withColumn("age", steps_between(F.col("last_observed_at"), F.col("timestamp"), step_seconds)).drop("__raw", "__changed")


def chunk_seeds(inside: DataFrame, by: Sequence[str], chunk: str, value: str) -> DataFrame:
    """(by, chunk, seed_sign, seed_since, seed_last): what holds before each chunk, from rows with the ``states`` of their chunk alone."""
    known = F.when(F.col("state_sign").isNotNull(), F.col("timestamp"))
    own = inside.groupBy(*by, chunk).agg(
        F.min_by("state_sign", known).alias("first"), F.min(known).alias("first_at"), F.max_by("state_sign", known).alias("sign"), F.max_by("state_since", known).alias("since"),
        F.max(F.when(F.col(value).isNotNull(), F.col("timestamp"))).alias("last"),
    )
    summary = own.select(*by, chunk, stretches.stretch(*[F.col(c) for c in ("first", "first_at", "sign", "since", "last")]).alias("e"))
    found = before_each(summary, by, chunk, "e", stretches.then)
    return found.select(*by, chunk, F.col("seed.sign").alias("seed_sign"), F.col("seed.since").alias("seed_since"), F.col("seed.last").alias("seed_last"))


def two_level_states(df: DataFrame, by: Sequence[str], value: str, deadband: float, step_seconds: int = 60, chunk_seconds: int = 86400) -> DataFrame:
    """``states`` for long series: each chunk is summarised, the summaries are scanned by blocks, and chunks start from their seeds.

    No task sees a whole series, nor all its chunks.
    """
    cut = df.withColumn("__chunk", F.floor(F.unix_seconds("timestamp") / chunk_seconds))
    seeds = chunk_seeds(states(cut, [*by, "__chunk"], value, deadband, step_seconds), by, "__chunk", value)
    return states(cut.join(seeds, [*by, "__chunk"], "left"), [*by, "__chunk"], value, deadband, step_seconds, seeded=True).drop("__chunk", "seed_sign", "seed_since", "seed_last")


def _ordered(part: Sequence[str]):
    return Window.partitionBy(*part).orderBy("timestamp")


def complete(expr: Column, value: str, n: int, part: Sequence[str]) -> Column:
    return F.when(F.count(value).over(_ordered(part).rowsBetween(1 - n, 0)) == n, expr)


def deltas(value: str, part: Sequence[str]) -> dict[str, Column]:
    w = _ordered(part)
    one, two = F.col(value) - F.lag(value, 1).over(w), F.col(value) - F.lag(value, 2).over(w)
    return {"delta_1_mw": one, "delta_2_mw": two, "acceleration_mw": one - (F.lag(value, 1).over(w) - F.lag(value, 2).over(w))}


def ewm(value: str, n: int, part: Sequence[str]) -> Column:
    """Exponential mean with alpha 2 / (n + 1), begun at the window's oldest value."""
    alpha = 2.0 / (n + 1)
    items = F.collect_list(value).over(_ordered(part).rowsBetween(1 - n, 0))
    return complete(F.aggregate(F.slice(items, 2, n), F.get(items, F.lit(0)), lambda a, x: alpha * x + (1 - alpha) * a), value, n, part)


def rolling_median(value: str, n: int, part: Sequence[str]) -> Column:
    return complete(F.percentile(value, F.lit(0.5)).over(_ordered(part).rowsBetween(1 - n, 0)), value, n, part)


def rolling_extremes(value: str, n: int, part: Sequence[str]) -> tuple[Column, Column]:
    w = _ordered(part).rowsBetween(1 - n, 0)
    return complete(F.min(value).over(w), value, n, part), complete(F.max(value).over(w), value, n, part)


def slope(value: str, n: int, part: Sequence[str]) -> Column:
    """Least-squares slope a step; the step's number stands in a column ``__i``."""
    return complete(F.regr_slope(F.col(value), F.col("__i")).over(_ordered(part).rowsBetween(1 - n, 0)), value, n, part)


def _middle(items: Column, n: int) -> Column:
    """Median of n values, sorted once."""
    at = lambda s, i: F.get(s, F.lit(i))
    return F.get(F.transform(F.array(F.sort_array(items)), lambda s: at(s, n // 2) if n % 2 else (at(s, n // 2 - 1) + at(s, n // 2)) / 2), F.lit(0))


def robust_scale(value: str, n: int, part: Sequence[str]) -> Column:
    """1.4826 times the median absolute deviation."""
    items = F.collect_list(value).over(_ordered(part).rowsBetween(1 - n, 0))
    once = F.array(F.struct(items.alias("x"), _middle(items, n).alias("m")))
    return complete(1.4826 * F.get(F.transform(once, lambda s: _middle(F.transform(s["x"], lambda x: F.abs(x - s["m"])), n)), F.lit(0)), value, n, part)


def local_features(df: DataFrame, part: Sequence[str], reg: Registry, seeded: bool = False) -> DataFrame:
    """All local features of each grid row, null where masked.  ``df`` is dense and has the observation's raw columns."""
    v = "system_imbalance_mw"
    out = states(df, part, v, reg.deadband, reg.step_seconds, seeded)
    out = out.withColumn("__i", (F.unix_seconds("timestamp") / reg.step_seconds).cast("double"))
    lo, hi = rolling_extremes(v, max(reg.median), part)
    made = {
        **deltas(v, part), **{f"ewm_{n}_mw": ewm(v, n, part) for n in reg.ewm}, **{f"rolling_median_{n}_mw": rolling_median(v, n, part) for n in reg.median},
        **{f"robust_scale_{n}_mw": robust_scale(v, n, part) for n in reg.scale}, **{f"slope_{n}_mw_per_minute": slope(v, n, part) for n in reg.slope},
        f"rolling_min_{max(reg.median)}_mw": lo, f"rolling_max_{max(reg.median)}_mw": hi, "boundary_distance_mw": F.abs(F.abs(F.col(v)) - reg.deadband),
        "quality_validated": F.when(F.col(v).isNotNull(), F.coalesce(F.lower("quality_status") == "validated", F.lit(False)).cast("double")),
        "confirmed_state_sign": F.col("state_sign").cast("double"), "state_duration_minutes": F.col("state_duration"), "imbalance_age_minutes": F.col("age"),
    }
    return out.withColumns(made).drop("__i")
