"""Candidate and baselines on one test section: forecasts of the next step from the same snapshots, scored by one report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contract import names
from ..functions.schemas import Registry
from ..functions.scratch import written
from ..operators import evaluate as E
from ..operators import forecast as M
from ..operators.isotonic import calibrate, isotonic_fit
from ..operators.labels import summary_features
from ..operators.splits import latest_purged_split

BASELINES = ("persistence", "clipped_linear_drift", "rolling_median", "classical")
_CHANNEL = "local_values", "local_masks"


def split_examples(examples: DataFrame, gap: timedelta, evaluation: timedelta, initial: timedelta) -> DataFrame:
    """Stored examples with their section and the observed values before the cutoff."""
    cut = latest_purged_split(examples, gap=gap, evaluation=evaluation, initial=initial).where("split is not null")
    return written(cut, "examples")


def simple_forecasts(examples: DataFrame, reg: Registry) -> DataFrame:
    """Add persistence, clipped_linear_drift and rolling_median, of the first channel's observed values."""
    h = M.observed_values(*_CHANNEL, width=len(reg.local))
    return examples.withColumns({"persistence": M.persistence(h), "clipped_linear_drift": M.linear_drift(h), "rolling_median": M.rolling_median(h)})


def _rows(df: DataFrame, model: str, value: str, keys: Sequence[str], band: float | None = None, flip: str | None = None) -> DataFrame:
    """Scored rows of a model; without a band its interval is its forecast, without flips they are forecast never."""
    v = F.col(value).cast("double")
    low, high = (v, v) if band is None else (v - F.lit(band), v + F.lit(band))
    p = F.lit(0.0) if flip is None else F.col(flip).cast("double")
    return df.select(
        F.lit(model).alias("model"), *keys, "cutoff", F.col("target_next").alias("actual"), v.alias("predicted"), low.alias("p10"), high.alias("p90"), F.col("flip_target").cast("int").alias("flip_target"), p.alias("flip_probability"),
        F.col("flip_mask").cast("int").alias("flip_mask"), "current_state", "quality_code", "volatility",
    )


def scored_models(examples: DataFrame, reg: Registry, keys: Sequence[str] = ("request_id",), rounds: int = 100) -> tuple[DataFrame, float]:
    """Scored rows of the test section for the candidate and the four baselines, and the candidate's threshold.

    Trees are fitted on the training section's summaries of all local, context and static channels.  The candidate is a linear model
    over all baselines, fitted on the validation section; its flips are the trees' calibrated on the calibration section, and its band is the residuals' 80 % there.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    width = len(reg.local)
    rest = [(f"{group}_values", f"{group}_masks", len(names(group))) for group in ("context", "static")]
    wide, features = summary_features(examples, *_CHANNEL, width, list(keys), rest, masked=True)
    v, m = (F.col(c) for c in _CHANNEL)
    x = simple_forecasts(examples, reg).withColumns({"quality_code": E.source_quality(v, m, width), "volatility": E.volatility(v, m, width)})
    x = written(x.drop(*_CHANNEL, *(c for v, m, _ in rest for c in (v, m))).join(wide, list(keys)), "summaries")
    trees = M.fit_trees(x.where("split = 'train'"), features, rounds=rounds)
    x = written(trees(x).withColumn("classical", F.col("tree_value")).drop(*features), "forecasts")
    assemble = VectorAssembler(inputCols=list(BASELINES), outputCol="__x")
    linear = LinearRegression(featuresCol="__x", labelCol="target_next", predictionCol="candidate", regParam=1.0).fit(assemble.transform(x.where("split = 'validation'")))
    x = linear.transform(assemble.transform(x)).drop("__x").withColumn("raw", F.col("tree_flip"))
    tuned = x.where("split = 'calibration'")
    model, threshold = isotonic_fit(tuned.where("flip_mask = 1"))
    band = float(tuned.agg(F.percentile(F.abs(F.col("target_next") - F.col("candidate")), F.lit(0.8))).first()[0] or 0.0)
    test = written(calibrate(x.where("split = 'test'"), model), "test")
    out = _rows(test, "candidate", "candidate", keys, band, "calibrated")
    for name in BASELINES:
        out = out.unionByName(_rows(test, name, name, keys, flip="tree_flip" if name == "classical" else None))
    return out, threshold


def compared(scored: DataFrame, threshold: float, keys: Sequence[str] = ("request_id",)) -> tuple[DataFrame, DataFrame]:
    """The report of each model, and of each cohort of each: the candidate's flips by its own threshold, the others' by one half."""
    mine, others = scored.where("model = 'candidate'"), scored.where("model <> 'candidate'")
    reports = E.comparison(mine, threshold, keys).unionByName(E.comparison(others, 0.5, keys))
    return reports, E.cohort_mae(E.with_cohorts(scored, keys, ["model"]), ["model"])
