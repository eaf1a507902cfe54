"""Forecast evaluation, cohorts, comparison and the promotion gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import average_precision, terciles

BRIER_MARGIN = 0.01


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def evaluation_report(df: DataFrame, threshold: float, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row for each group: MAE, RMSE, Brier, log loss, precision, recall, F1, interval coverage and PR-AUC.

    Columns actual, predicted, p10, p90, flip_target (0 or 1), flip_probability, flip_mask.  Flip figures only count rows
    with a known label; ``invalid`` counts what an evaluation must not have.
    """
    known, t, p = F.col("flip_mask") == 1, F.col("flip_target"), F.col("flip_probability")
    called = p >= threshold
    clipped = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    err = F.col("predicted") - F.col("actual")
    bad = F.lit(False)
    for c in ("actual", "predicted", "p10", "p90", "flip_target", "flip_probability"):
        bad = bad | F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    bad = F.coalesce(bad | (F.col("p10") > F.col("p90")) | ~t.isin(0, 1), F.lit(True))
    n = lambda c: F.count_if(known & c)
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(known).alias("known"), F.count_if(bad).alias("invalid"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.when(known, (p - t) * (p - t))).alias("brier"), (-F.avg(F.when(known, t * F.log(clipped) + (1 - t) * F.log1p(-clipped)))).alias("log_loss"),
        n(called & (t == 1)).alias("tp"), n(called & (t == 0)).alias("fp"), n(~called & (t == 1)).alias("fn"),
        F.avg(((F.col("actual") >= F.col("p10")) & (F.col("actual") <= F.col("p90"))).cast("double")).alias("interval_coverage"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = agg.withColumns({"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn)}).drop("tp", "fp", "fn")
    auc = average_precision(df.where(known), "flip_target", "flip_probability", ties, by)
    if by:
        return out.join(auc, list(by), "left")
    return out.withColumn("__one", F.lit(1)).join(auc.withColumn("__one", F.lit(1)), "__one", "left").drop("__one")


def require_valid(report: DataFrame) -> None:
    if report.where((F.col("invalid") > 0) | (F.col("known") == 0) | (F.col("rows") == 0)).limit(1).count() or report.isEmpty():
        raise ValueError("an evaluation needs finite rows, ordered intervals and at least one known label")


def source_quality(values: Column, masks: Column, width: int, channel: int = 5) -> Column:
    """1 or 0 as the last row's quality channel says, -1 if it is masked or there is no such channel."""
    if width <= channel:
        return F.lit(-1)
    at = F.size(values) - width + channel
    return F.when(F.coalesce(F.get(masks, at) == 1, F.lit(False)), (F.get(values, at) > 0.5).cast("int")).otherwise(-1)


def volatility(values: Column, masks: Column, width: int) -> Column:
    """Population deviation of the observed values of the first channel, 0 without any."""
    own = F.transform(F.filter(F.arrays_zip(values.alias("v"), masks.alias("m")), lambda x, i: (i % width == 0) & (x["m"] == 1)), lambda x: x["v"].cast("double"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    once = F.transform(F.array(own), lambda a: F.struct(a.alias("a"), F.try_divide(total(a), F.size(a)).alias("m")))
    return F.get(F.transform(once, lambda s: F.when(F.size(s["a"]) > 0, F.sqrt(total(F.transform(s["a"], lambda x: (x - s["m"]) * (x - s["m"]))) / F.size(s["a"]))).otherwise(0.0)), F.lit(0))


def with_cohorts(df: DataFrame, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``cohorts``: state, phase of the quarter hour, source quality and volatility tercile.

    Columns current_state, cutoff, quality_code (see ``source_quality``), volatility; terciles are those of each group.
    """
    from ..functions.scalars import phase_cohort

    ranked = terciles(df, "volatility", ties, by)
    state = F.concat(F.lit("current_"), F.coalesce("current_state", F.lit("unknown")))
    quality = F.when(F.col("quality_code") == 1, "source_quality_validated").when(F.col("quality_code") == 0, "source_quality_unvalidated").otherwise("source_quality_unknown")
    volatility = F.when(F.col("tercile") == 1, "low_volatility").when(F.col("tercile") == 2, "medium_volatility").otherwise("high_volatility")
    return ranked.withColumn("cohorts", F.array(state, phase_cohort(F.col("cutoff")), quality, volatility)).drop("tercile")


def cohort_mae(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error of each cohort that has rows; cohorts overlap."""
    long = df.select(*by, F.abs(F.col("predicted") - F.col("actual")).alias("e"), F.explode("cohorts").alias("cohort"))
    return long.groupBy(*by, "cohort").agg(F.avg("e").alias("mae"), F.count(F.lit(1)).alias("rows"))


def comparison(scored: DataFrame, threshold: float, ties: Sequence[str]) -> DataFrame:
    """A report for each model of a long table of scored rows (column ``model``)."""
    return evaluation_report(scored, threshold, ties, ["model"])


def promotion_decision(reports: DataFrame, cohorts: DataFrame, candidate: str = "candidate", persistence: str = "persistence", classical: str = "classical") -> DataFrame:
    """promote and all reasons against it, from the reports and cohort errors of the three models.  One row."""
    pick = lambda c, m: F.max(F.when(F.col("model") == m, F.col(c)))
    r = reports.agg(
        pick("mae", candidate).alias("mae"), pick("mae", persistence).alias("base_mae"), pick("pr_auc", candidate).alias("auc"), pick("pr_auc", classical).alias("base_auc"),
        pick("brier", candidate).alias("brier"), pick("brier", classical).alias("base_brier"), pick("interval_coverage", candidate).alias("coverage"),
    )
    c = cohorts.groupBy("cohort").agg(pick("mae", candidate).alias("c"), pick("mae", persistence).alias("p")).where(F.col("p").isNotNull() & (F.col("c").isNull() | (F.col("c") > F.col("p") * 1.05)))
    worse = c.agg(F.array_sort(F.collect_list(F.concat(F.lit("cohort:"), F.col("cohort")))).alias("worse"))
    both = r.withColumn("__one", F.lit(1)).join(worse.withColumn("__one", F.lit(1)), "__one", "left")
    own = F.array_compact(
        F.array(
            F.when(F.col("mae") > F.col("base_mae") * 0.98, "mae"), F.when(F.col("auc") <= F.col("base_auc"), "pr_auc"),
            F.when(F.col("brier") > F.col("base_brier") - BRIER_MARGIN, "brier"), F.when(~F.col("coverage").between(0.75, 0.85), "coverage"),
        )
    )
    reasons = F.concat(own, F.coalesce("worse", F.array().cast("array<string>")))
    return both.select((F.size(reasons) == 0).alias("promote"), reasons.alias("reasons"))


def validation_objective(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean negative log likelihood plus a quarter of the mean squared flip error on known labels; weighted by rows."""
    known = F.col("flip_mask") == 1
    brier = F.avg(F.when(known, (F.col("flip_probability") - F.col("flip_target")) ** 2))
    return df.groupBy(*by).agg((F.avg("nll") + 0.25 * F.coalesce(brier, F.lit(0.0))).alias("objective"))


def positive_weight(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    known = F.col("flip_mask") == 1
    pos, neg = F.count_if(known & (F.col("flip_target") == 1)), F.count_if(known & (F.col("flip_target") == 0))
    return df.groupBy(*by).agg(F.when(pos > 0, neg / pos).otherwise(1.0).alias("positive_weight"))
