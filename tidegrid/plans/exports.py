"""Training-set exports: from versioned tables and from the portal's CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import event_id, iso_ms, row_version
from ..functions.schemas import Registry
from ..functions.scalars import history_start, shift
from ..functions.scratch import written
from ..operators.grid import evenly_spaced, require_contiguous, select_cutoffs
from ..operators.labels import HORIZONS, training_examples
from ..operators.pit import canonical_latest
from ..sources.records import minute_rows
from ..sources.sinks import export_dataset
from .snapshots import snapshots_pit


def requests_for(cutoffs: DataFrame, by: Sequence[str] = ("series",), knowledge_lag: int = 0) -> DataFrame:
    """(request_id, by, cutoff, knowledge): what is known ``knowledge_lag`` seconds after the cutoff."""
    return cutoffs.select(F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in by], iso_ms("cutoff")), 256).alias("request_id"), *by, "cutoff", shift(F.col("cutoff"), knowledge_lag).alias("knowledge"))


def examples_from_tables(obs: DataFrame, cutoffs: DataFrame, reg: Registry, by: Sequence[str] = ("series",), knowledge_lag: int = 0, check: bool = True, end=None) -> DataFrame:
    """Examples at the cutoffs, point in time, labelled with the revisions known by ``end``.

    With ``check``, a step missing between the oldest history and the last cutoff's next step is an error.
    Labels are taken of the steps that cutoffs look ahead to, not of all.
    """
    cutoffs = written(cutoffs, "cutoffs")
    if check:
        span = cutoffs.agg(F.min(history_start(F.col("cutoff"), reg.bins, reg.bin_steps, reg.step_seconds)), F.max(shift(F.col("cutoff"), reg.step_seconds))).first()
        require_contiguous(obs, span[0], span[1], by=by, step_seconds=reg.step_seconds)
    snaps = snapshots_pit(obs, requests_for(cutoffs, by, knowledge_lag), reg, by)
    ahead = cutoffs.select(*by, F.explode(F.array(*[shift(F.col("cutoff"), h * reg.step_seconds) for h in (1, *HORIZONS)])).alias("timestamp")).distinct()
    labels = canonical_latest(obs.join(ahead, [*by, "timestamp"], "left_semi"), [*by, "timestamp"], end)
    return training_examples(snaps, labels, reg.deadband, by, reg.step_seconds)


def export_from_tables(obs: DataFrame, cutoffs: DataFrame, reg: Registry, path: str, force: bool = False, **kwargs) -> dict:
    return export_dataset(examples_from_tables(obs, cutoffs, reg, **kwargs), path, force)


def observations_from_csv(spark: SparkSession, path: str, series: str = "portal") -> DataFrame:
    """CSV minutes as versions that were available in their own minute."""
    rows = minute_rows(spark, path).withColumn("series", F.lit(series)).withColumn("ingested_at", F.col("timestamp"))
    rows = rows.withColumn("event_id", event_id(F.lit("portal"), F.lit("csv"), iso_ms("timestamp"), F.lit("1")))
    return rows.withColumn("row_version", row_version("ingested_at", "event_id"))


def export_from_csv(spark: SparkSession, csv: str, path: str, reg: Registry | None = None, stride: int = 30, start=None, end=None, max_examples: int | None = None, force: bool = False) -> dict:
    reg = reg or Registry()
    # a minute has one version, so what ranks versions decides nothing and isn't shuffled
    obs = observations_from_csv(spark, csv).withColumns({"event_id": F.lit(""), "row_version": F.lit(0).cast("bigint")})
    cutoffs = select_cutoffs(obs, reg.history_steps + reg.bin_steps, stride, start, end, step_seconds=reg.step_seconds)
    if max_examples:
        cutoffs = evenly_spaced(cutoffs, max_examples)
    return export_dataset(examples_from_tables(obs, cutoffs, reg, check=False), path, force)
