"""Baselines, calibration, mixture scoring, fallback forecasts and outcomes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import advance_sign, flip, isotonic, predicted_state, state_name, state_sign
from ..functions.scratch import workers_find_package
from . import boosting
from .pit import canonical_latest, realised_join

DRIFT = 15


def observed_values(values: str, masks: str, width: int = 1, channel: int = 0) -> Column:
    """Observed values of one channel of a flattened window, in order."""
    pairs = F.filter(F.arrays_zip(F.col(values).alias("v"), F.col(masks).alias("m")), lambda x, i: (i % width == channel) & (x["m"] == 1))
    return F.transform(pairs, lambda x: x["v"].cast("double"))


def persistence(history: Column) -> Column:
    return F.coalesce(F.get(history, F.size(history) - 1), F.lit(0.0))


def _tail(history: Column) -> Column:
    return F.slice(history, F.greatest(F.lit(1), F.size(history) - DRIFT + 1), DRIFT)


def linear_drift(history: Column) -> Column:
    """Least squares over the last 15 observed values, one step on, within their range; persistence for fewer than two."""
    h = _tail(history)
    n = F.size(h).cast("double")
    sy = F.aggregate(h, F.lit(0.0), lambda a, x: a + x)
    sxy = F.aggregate(F.transform(h, lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    sx, sxx = n * (n - 1) / 2, n * (n - 1) * (2 * n - 1) / 6
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    ahead = (sy - slope * sx) / n + slope * n
    return F.when(F.size(h) < 2, persistence(history)).otherwise(F.least(F.array_max(h), F.greatest(F.array_min(h), ahead)))


def rolling_median(history: Column) -> Column:
    s = F.array_sort(_tail(history))
    n = F.size(s)
    return F.coalesce((F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2, F.lit(0.0))


def fit_trees(train: DataFrame, features: list[str], target: str = "target_next", flip_target: str = "flip_target", rounds: int = 100, step: float = 0.05):
    """Boosted-tree baseline: a function that adds tree_value and tree_flip.  One class only gives its rate, none gives 0.

    Null features are masked, and each cut has a side for them.
    """
    model = boosting.fit(train, features, [(target, False, None), (flip_target, True, "flip_mask")], rounds, step)
    return lambda df: model.apply(df, ["tree_value", "tree_flip"])


def calibrated(df: DataFrame, xs: list[float], ys: list[float], probability: str = "raw") -> DataFrame:
    """Calibration by the thresholds of a stored bundle; a fitted table is applied by ``isotonic.calibrate``."""
    array = lambda v: F.array(*[F.lit(float(x)) for x in v])
    return df.withColumn("calibrated", isotonic(F.col(probability).cast("double"), array(xs), array(ys)))


def _normal_cdf(z: np.ndarray) -> np.ndarray:
    """Standard normal distribution: the error function's power series near 0, its tail's continued fraction beyond."""
    x = np.minimum(np.abs(z), 40.0)
    small = np.minimum(x, 3.0)
    term = total = small
    for k in range(1, 60):
        term = term * small * small / (2 * k + 1)
        total = total + term
    density = lambda v: np.exp(-v * v / 2) / np.sqrt(2 * np.pi)
    inner = 0.5 - density(small) * total
    large = np.maximum(x, 3.0)
    fraction = large
    for k in range(60, 0, -1):
        fraction = large + k / fraction
    tail = np.where(x < 3.0, inner, density(large) / fraction)
    return np.where(z >= 0, 1 - tail, tail)


_MIXTURE = "p10 double, median double, p90 double, nll double, below double, above double"


def _mixtures(deadband: float):
    def run(weights: pd.Series, means: pd.Series, scales: pd.Series, actual: pd.Series) -> pd.DataFrame:
        if not len(weights):
            return pd.DataFrame({c.split()[0]: pd.Series(dtype=float) for c in _MIXTURE.split(", ")})
        size = max(map(len, weights))
        grid = lambda s, fill: np.array([np.concatenate([np.asarray(v, float), np.full(size - len(v), fill)]) for v in s])
        w, m, s = grid(weights, 0.0), grid(means, 0.0), grid(scales, 1.0)
        there = w > 0
        cdf = lambda x: (w * _normal_cdf((x[:, None] - m) / s)).sum(axis=1)
        wide = 12 * np.where(there, s, 0).max(axis=1)
        lo0, hi0 = np.where(there, m, np.inf).min(axis=1) - wide, np.where(there, m, -np.inf).max(axis=1) + wide
        out = {}
        for name, q in (("p10", 0.1), ("median", 0.5), ("p90", 0.9)):
            lo, hi = lo0.copy(), hi0.copy()
            for _ in range(64):
                mid = (lo + hi) / 2
                less = cdf(mid) < q
                lo, hi = np.where(less, mid, lo), np.where(less, hi, mid)
            out[name] = (lo + hi) / 2
        y = actual.to_numpy(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = np.log(w) - 0.5 * ((y[:, None] - m) / s) ** 2 - np.log(s) - 0.5 * np.log(2 * np.pi)
            top = parts.max(axis=1)
            out["nll"] = -(top + np.log(np.exp(parts - top[:, None]).sum(axis=1)))
        # each tail as a sum of its own: the weights add up to 1 but for rounding, so a complement may fall below 0, and a sum rise above 1
        out["below"] = np.minimum((w * _normal_cdf((-deadband - m) / s)).sum(axis=1), 1.0)
        out["above"] = np.minimum((w * _normal_cdf((m - deadband) / s)).sum(axis=1), 1.0)
        return pd.DataFrame(out)

    return F.pandas_udf(run, _MIXTURE)


def ensemble_scores(members: DataFrame, deadband: float, keys: tuple[str, ...] = ("example",), actual: str | None = None, xs: list[float] | None = None, ys: list[float] | None = None, threshold: float = 0.5) -> DataFrame:
    """Combine members' Gaussian mixtures (logits, means, log_scales arrays, flip_logit, delta, current_state) for each example.

    Softmax weights share alike among members, scales are softplus + 1e-4; quantiles by 64 bisections over whole Arrow
    batches, since Spark has no error function.
    """
    workers_find_package(members.sparkSession)
    top = F.array_max("logits")
    e = F.transform("logits", lambda x: F.exp(x - top))
    soft = F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))
    wide = F.transform("log_scales", lambda x: F.log1p(F.exp(-F.abs(x))) + F.greatest(x, F.lit(0.0)) + 1e-4)
    order = F.array_sort(F.collect_list(F.struct("member", soft.alias("w"), F.col("means").alias("m"), wide.alias("s"))))
    extra = [F.first(actual).alias("__actual")] if actual else []
    g = members.groupBy(*keys).agg(order.alias("o"), F.avg("flip_logit").alias("logit"), F.avg("delta").alias("delta_mw"), F.first("current_state").alias("current_state"), *extra)
    flat = lambda f: F.flatten(F.transform("o", lambda x: x[f]))
    weights = F.transform(flat("w"), lambda x: x / F.size("o"))
    y = F.col("__actual").cast("double") if actual else F.lit(None).cast("double")
    made = g.withColumn("d", _mixtures(deadband)(weights, flat("m"), flat("s"), y))
    raw = 1 / (1 + F.exp(-F.col("logit")))
    p = calibrated(made.withColumn("raw", raw), xs or [0.0, 1.0], ys or [0.0, 1.0])
    will = F.col("current_state").isNotNull() & (F.col("calibrated") >= threshold)
    side = F.when(F.col("current_state") == "positive", F.col("d.below")).when(F.col("current_state") == "negative", F.col("d.above")).otherwise(0.5)
    return p.select(
        *keys, F.col("d.p10").alias("p10_mw"), F.col("d.median").alias("system_imbalance_mw"), F.col("d.p90").alias("p90_mw"), F.col("calibrated").alias("flip_probability"), will.alias("will_flip"),
        "current_state", predicted_state(F.col("current_state"), will, F.col("d.median"), deadband).alias("predicted_state"), "delta_mw", F.col("d.nll").alias("nll"), side.alias("distribution_flip_probability"),
    )


def sane(df_prefix: str = "") -> Column:
    """Finite numbers, ordered interval, probability in range, and a forecast flip that leaves the current state."""
    c = lambda n: F.col(df_prefix + n)
    ok = F.lit(True)
    for n in ("system_imbalance_mw", "p10_mw", "p90_mw", "flip_probability", "delta_mw"):
        ok = ok & c(n).isNotNull() & ~F.isnan(c(n)) & (F.abs(c(n)) != float("inf"))
    flips = ~c("will_flip") | (c("current_state").isNotNull() & ~c("predicted_state").eqNullSafe(c("current_state")))
    return F.coalesce(ok & (c("p10_mw") <= c("p90_mw")) & c("flip_probability").between(0, 1) & flips, F.lit(False))


def forecasts(snapshots: DataFrame, scores: DataFrame, deadband: float, keys: tuple[str, ...] = ("example",)) -> DataFrame:
    """A forecast for each snapshot (keys, eligible, latest, current_state): the model's if sound, else its last value.

    Rows with ``rejected`` have no observed last value either and go to the dead letters.
    """
    s = scores.withColumn("sound", sane()).withColumnRenamed("current_state", "scored_state")
    j = snapshots.join(s, list(keys), "left")
    reason = F.when(~F.col("eligible"), "insufficient_feature_history").when(F.col("sound").isNull(), "model_bundle_unavailable").when(~F.col("sound") | ~F.col("scored_state").eqNullSafe(F.col("current_state")), "model_inference_failed")
    degraded, last = F.col("reason").isNotNull(), F.col("latest")
    fallen = state_name(advance_sign(state_sign(F.col("current_state")), last, deadband))
    pick = lambda own, other: F.when(degraded, own).otherwise(other)
    j = j.withColumn("reason", reason)
    return j.select(
        *keys, "current_state", pick(last, F.col("system_imbalance_mw")).alias("system_imbalance_mw"), pick(last, F.col("p10_mw")).alias("p10_mw"), pick(last, F.col("p90_mw")).alias("p90_mw"),
        pick(F.lit(0.0), F.col("flip_probability")).alias("flip_probability"), pick(F.lit(False), F.col("will_flip")).alias("will_flip"), pick(fallen, F.col("predicted_state")).alias("predicted_state"),
        F.when(degraded, "degraded").otherwise("model").alias("prediction_quality"), F.col("reason").alias("degraded_reason"), (degraded & last.isNull()).alias("rejected"),
    )


def reconcile(predictions: DataFrame, obs: DataFrame, now, deadband: float, by: Sequence[str] = ("series",)) -> DataFrame:
    """Outcomes of predictions that came late, against the latest revision known ``now``; their ids are those of the direct path."""
    latest = canonical_latest(obs, [*by, "timestamp"], now)
    realised = latest.select(*by, "timestamp", F.col("event_id").alias("realized_event_id"), F.col("system_imbalance_mw").alias("realized_value"), F.col("ingested_at").alias("available_at"))
    return evaluate_outcomes(realised_join(predictions, realised, by), deadband)


def evaluate_outcomes(joined: DataFrame, deadband: float) -> DataFrame:
    """Outcomes of predictions joined with realisations (see ``realised_join``): state from the forecast's, flip, time known."""
    state = state_name(advance_sign(state_sign(F.col("current_state")), F.col("realized_value"), deadband))
    return joined.select(
        F.col("event_id").alias("prediction_event_id"), "target_time", "realized_event_id", F.col("realized_value").alias("realized_system_imbalance_mw"), state.alias("realized_state"),
        flip(F.col("current_state"), state).alias("flip_actual"), F.col("available_at").alias("evaluated_at"),
    )
