"""Labels of future values and robust preprocessing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import advance_sign, flip, scaled, shift, state_name, state_sign
from .ranks import running

HORIZONS = (2, 5, 10)


def future_values(obs: DataFrame, by: Sequence[str] = ("series",), step_seconds: int = 60, horizons: Sequence[int] = (1, *HORIZONS)) -> DataFrame:
    """For each cutoff that has any: the values so many steps later, as one grouping instead of a join for each horizon."""
    shifted = obs.select(*by, F.col("system_imbalance_mw").alias("v"), F.explode(F.array(*[F.struct(F.lit(h).alias("h"), shift(F.col("timestamp"), -h * step_seconds).alias("cutoff")) for h in horizons])).alias("x"))
    return shifted.groupBy(*by, "x.cutoff").agg(*[F.max(F.when(F.col("x.h") == h, F.col("v"))).alias(f"v_{h}") for h in horizons])


def training_examples(snapshots: DataFrame, obs: DataFrame, deadband: float, by: Sequence[str] = ("series",), step_seconds: int = 60) -> DataFrame:
    """Snapshots that have a next value, with targets and masks.  ``latest`` is the snapshot's value at the cutoff, or null."""
    j = snapshots.join(future_values(obs, by, step_seconds), [*by, "cutoff"]).where("v_1 is not null")
    future = state_name(advance_sign(state_sign(F.col("current_state")), F.col("v_1"), deadband))
    turned = flip(F.col("current_state"), future)
    aux = F.array(*[F.coalesce(f"v_{h}", F.lit(0.0)) for h in HORIZONS])
    return j.withColumns(
        {
            "target_next": F.col("v_1"), "target_delta": F.col("v_1") - F.coalesce("latest", F.lit(0.0)), "delta_mask": F.col("latest").isNotNull().cast("double"),
            "auxiliary_target": aux, "auxiliary_mask": F.array(*[F.col(f"v_{h}").isNotNull().cast("double") for h in HORIZONS]),
            "flip_target": F.coalesce(turned.cast("double"), F.lit(0.0)), "flip_mask": turned.isNotNull().cast("double"),
        }
    ).drop(*[f"v_{h}" for h in (1, *HORIZONS)])


def channels(df: DataFrame, values: str, masks: str, width: int, keep: Sequence[str] = ()) -> DataFrame:
    """Long form of flattened features: (channel, place, value, mask)."""
    pairs = F.arrays_zip(F.col(values).alias("value"), F.col(masks).alias("mask"))
    return df.select(*keep, F.posexplode(pairs).alias("i", "x")).select(*keep, (F.col("i") % width).alias("channel"), F.floor(F.col("i") / width).alias("place"), F.col("x.value").alias("value"), F.col("x.mask").alias("mask"))


def fit_scaler(long: DataFrame, group: Sequence[str] = ("channel",)) -> DataFrame:
    """Median and interquartile range (1e-6 at least) of each channel's observed values; 0 and 1 without any.

    Exact, over all rows: values are ranked by ranges, and the two beside each quantile picked, so no task holds a channel.
    """
    seen = running(long.where("mask = 1 and value is not null").select(*group, "value"), F.col("value"), [], {}, group)
    made = []
    for name, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
        at = (F.col("total") - 1) * q
        pick = lambda i: F.max(F.when(F.col("rank") == i + 1, F.col("value")))
        part = F.max(at - F.floor(at))
        made.append((pick(F.floor(at)) * (1 - part) + pick(F.ceil(at)) * part).alias(name))
    stats = seen.groupBy(*group).agg(*made)
    both = long.select(*group).distinct().join(stats, list(group), "left")
    return both.select(*group, F.coalesce("q2", F.lit(0.0)).alias("location"), F.coalesce(F.greatest(F.lit(1e-6), F.col("q3") - F.col("q1")), F.lit(1.0)).alias("scale"))


def fit_preprocessing(examples: DataFrame, values: str, masks: str, width: int) -> tuple[str, DataFrame]:
    """The feature schema's hash and the statistics of each channel, from training rows only (``split`` is train, if there is a split)."""
    rows = examples.where("split = 'train'") if "split" in examples.columns else examples
    hashes = [r[0] for r in rows.select("feature_schema_hash").distinct().limit(2).collect()]
    if len(hashes) != 1:
        raise ValueError("preprocessing needs training examples, all of one feature schema")
    return hashes[0], fit_scaler(channels(rows, values, masks, width))


def apply_preprocessing(examples: DataFrame, fitted: tuple[str, DataFrame], values: str, masks: str, width: int, keep: Sequence[str]) -> DataFrame:
    """Scaled values in long form; rows of another feature schema are an error."""
    if examples.where(~F.col("feature_schema_hash").eqNullSafe(F.lit(fitted[0]))).limit(1).count():
        raise ValueError("the feature schema differs from the fitted one")
    return apply_scaler(channels(examples, values, masks, width, keep), fitted[1])


def summary_features(examples: DataFrame, values: str, masks: str, width: int, keys: Sequence[str], more: Sequence[tuple[str, str, int]] = (), masked: bool = False) -> tuple[DataFrame, list[str]]:
    """One row of channel summaries for each example, and the names of their columns.

    The channels of ``more`` arrays (values, masks, width) follow, all summarised in one grouping.  With ``masked``, a channel
    without observed values has null for zero but in its coverage.
    """
    parts, first, long = ("last", "mean", "std", "change", "coverage"), 0, []
    for values, masks, width in [(values, masks, width), *more]:
        long.append(channels(examples, values, masks, width, keys).withColumn("channel", (F.col("channel") + first).cast("int")))
        first += width
    s = channel_summary(reduce(DataFrame.unionAll, long), keys)
    seen = lambda p: F.col(p) if p == "coverage" or not masked else F.when(F.col("coverage") > 0, F.col(p))
    wide = s.groupBy(*keys).agg(*[F.max(F.when(F.col("channel") == c, seen(p))).alias(f"x{c}_{p}") for c in range(first) for p in parts])
    return wide, [f"x{c}_{p}" for c in range(first) for p in parts]


def apply_scaler(long: DataFrame, stats: DataFrame, group: Sequence[str] = ("channel",)) -> DataFrame:
    """Scaled values; the statistics are a row for each channel."""
    return long.join(stats, list(group), "left").withColumn("scaled", scaled(F.col("value"), F.col("mask"), F.col("location"), F.col("scale")))


def channel_summary(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last, mean, population deviation, last minus first and coverage of each channel's observed values; zeros without any."""
    v, at = F.when(F.col("mask") == 1, F.col("value")), F.when(F.col("mask") == 1, F.col("place"))
    g = long.groupBy(*keys, "channel").agg(F.max_by("value", at).alias("last"), F.min_by("value", at).alias("first"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), (F.count(v) / F.count(F.lit(1))).alias("coverage"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return g.select(*keys, "channel", zero(F.col("last")).alias("last"), zero(F.col("mean")).alias("mean"), zero(F.col("std")).alias("std"), zero(F.col("last") - F.col("first")).alias("change"), F.col("coverage"))
