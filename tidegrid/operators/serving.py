"""Reads that serve forecasts: latest, ranges with keyset paging, dashboards, the current model, bounded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import result_badge
from .pit import canonical_predictions, latest_revision, time_range, with_outcomes

PAGE, DASHBOARD = 10_000, 500


def latest_prediction(predictions: DataFrame) -> DataFrame:
    """The one row of greatest target time, revision, generation time and id."""
    return predictions.orderBy(*[F.desc(c) for c in ("target_time", "row_version", "generated_at", "event_id")]).limit(1)


def prediction_page(predictions: DataFrame, start, end, limit: int = 500, cursor: tuple | None = None) -> DataFrame:
    """Canonical predictions of [start, end) in order of (target_time, event_id), after the cursor, one more than ``limit``."""
    if not 1 <= limit <= PAGE:
        raise ValueError(f"limit must be within 1 and {PAGE}")
    if cursor is not None and (len(cursor) != 2 or None in cursor):
        raise ValueError("a cursor has a time and an id")
    rows = canonical_predictions(time_range(predictions, start, end, "target_time"))
    if cursor is not None:
        t, e = F.lit(cursor[0]).cast("timestamp"), F.lit(cursor[1])
        rows = rows.where((F.col("target_time") > t) | ((F.col("target_time") == t) & (F.col("event_id") > e)))
    return rows.orderBy("target_time", "event_id").limit(limit + 1)


def page_and_cursor(page: DataFrame, limit: int) -> tuple[list, tuple | None]:
    """A page's rows and where the next begins, if there is one.  At most ``limit`` + 1 rows come to the driver."""
    rows = page.collect()
    more = len(rows) > limit
    rows = rows[:limit]
    return rows, (rows[-1]["target_time"], rows[-1]["event_id"]) if more else None


def predictions_for_target(predictions: DataFrame, target) -> DataFrame:
    """Canonical predictions of one time; which of them count is the outcome join's business."""
    return canonical_predictions(predictions.where(F.col("target_time") == F.lit(target).cast("timestamp"))).orderBy("event_id")


def dashboard_rows(predictions: DataFrame, outcomes: DataFrame, start, end, limit: int = DASHBOARD) -> DataFrame:
    """Canonical predictions of [start, end] with outcome, badge and error, in order."""
    if not 1 <= limit <= PAGE:
        raise ValueError(f"limit must be within 1 and {PAGE}")
    rows = with_outcomes(time_range(predictions, start, end, "target_time", closed=True), time_range(outcomes, start, end, "target_time", closed=True))
    rows = rows.withColumn("badge", result_badge(F.col("predicted_state"), F.col("realized_state"))).withColumn("forecast_error", F.col("system_imbalance_mw") - F.col("realized_system_imbalance_mw"))
    return rows.orderBy("target_time", "event_id").limit(limit)


def dashboard_summary(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Latest forecast and realisation, their difference, the range over both series and the number of rows."""
    at, real = F.struct("target_time", "event_id"), F.col("realized_system_imbalance_mw")
    g = rows.groupBy(*by).agg(
        F.max_by("system_imbalance_mw", at).alias("latest_prediction"), F.max_by(real, F.when(real.isNotNull(), at)).alias("latest_realised"), F.max_by("forecast_error", F.when(real.isNotNull(), at)).alias("latest_error"),
        F.least(F.min("system_imbalance_mw"), F.min(real)).alias("least"), F.greatest(F.max("system_imbalance_mw"), F.max(real)).alias("greatest"), F.count(F.lit(1)).alias("rows"),
    )
    return g


def current_model(models: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The promoted model version of greatest promotion time and revision."""
    promoted = models.where("promoted_at is not null").withColumn("__all", F.lit(1))
    return latest_revision(promoted, [*by, "__all"], ("promoted_at", "row_version")).drop("__all")


def bounded_sample(df: DataFrame, k: int, key: str = "event_id", seed: int = 17) -> DataFrame:
    """The k rows of least seeded hash: the same rows however they are dealt."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(k)


__all__ = ["bounded_sample", "current_model", "dashboard_rows", "dashboard_summary", "latest_prediction", "page_and_cursor", "prediction_page", "predictions_for_target"]
