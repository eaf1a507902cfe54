"""Snapshots that follow the observations: each micro-batch makes those that its steps reach, and none is taken back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.scalars import floor_steps, history_start, minute_range, shift
from ..functions.schemas import Registry
from ..functions.scratch import written
from ..operators.pit import RANK, day_level, day_revisions, validity_intervals
from ..plans.snapshots import RAW, snapshots_pit

_MONTH = "yyyy-MM"


def _batches(spark: SparkSession, path: str, schema: StructType, upto: int, month: bool = False) -> DataFrame:
    """Rows of batches up to one: what came later is not read, so that a batch that is run again finds what it found before."""
    more = [StructField("batch", IntegerType()), *([StructField("month", StringType())] if month else [])]
    return spark.read.schema(StructType([*schema.fields, *more])).option("basePath", path).parquet(path).where(F.col("batch") <= upto)


def reached_cutoffs(changed: DataFrame, there: DataFrame, reg: Registry, every: int, by: Sequence[str] = ("series",)) -> DataFrame:
    """Requests of the cutoffs that changed steps reach: every ``every``-th step that has been observed (``there``: by, timestamp), from the
    changed one on until it is older than a snapshot's history.  Knowledge is the latest of the changes that reach the cutoff."""
    grid, size = every * reg.step_seconds, reg.bin_steps * reg.step_seconds
    span = reg.bins * size + size
    first = shift(floor_steps(shift(F.col("timestamp"), grid - 1), grid), 0)
    latest = changed.groupBy(*by, "timestamp").agg(F.max("ingested_at").alias("ingested_at"))  # a row for each step, however often it changed
    near = latest.select(*by, "timestamp", "ingested_at", F.explode(F.filter(minute_range(first, shift(F.col("timestamp"), span + grid), grid), lambda c: history_start(c, reg.bins, reg.bin_steps, reg.step_seconds) <= F.col("timestamp"))).alias("cutoff"))
    asked = near.groupBy(*by, "cutoff").agg(F.max("ingested_at").alias("knowledge"))
    seen = there.select(*by, F.col("timestamp").alias("cutoff")).distinct()
    ids = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in by], F.unix_millis("cutoff").cast("string"), F.unix_micros("knowledge").cast("string")), 256)
    return asked.join(seen, [*by, "cutoff"], "left_semi").select(ids.alias("request_id"), *by, "cutoff", "knowledge")


def snapshot_batch(root: str, reg: Registry, every: int = 1, by: Sequence[str] = ("series",)) -> Callable[[DataFrame, int], None]:
    """A micro-batch of observations: history, summaries of the days it changed, and snapshots, each under its batch id.

    The summaries are made from the changed days alone, and snapshots read the months that their histories lie in; all else of the past is in
    the summaries.  Of many revisions of a step only those go through a shuffle that a summary or a snapshot can find; a month's rows are
    written by as many tasks as their size asks for.  A batch that is run again overwrites its own folders from what there was before it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = batch.select(*by, "timestamp", *RANK, *RAW)
        kinds = own.schema
        month = lambda c: F.date_format(c, _MONTH)
        own.withColumn("month", month("timestamp")).hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{root}/history/batch={batch_id}")
        history = _batches(spark, f"{root}/history", kinds, batch_id, month=True)
        mine = spark.read.schema(kinds).parquet(f"{root}/history/batch={batch_id}")
        in_months = lambda days: history.where(F.col("month").isin([r[0] for r in days.select(month("day")).distinct().collect()]))  # noqa: E731  months are few

        changed = written(mine.groupBy(*by, "timestamp").agg(F.max("ingested_at").alias("ingested_at")), "changed")
        changed_days = written(changed.select(*by, F.date_trunc("DAY", "timestamp").alias("day")).distinct(), "changed-days")
        touched = in_months(changed_days).withColumn("day", F.date_trunc("DAY", "timestamp")).join(changed_days, [*by, "day"], "left_semi")
        day_level(validity_intervals(day_revisions(touched, by), [*by, "timestamp"]), reg.deadband, by).write.mode("overwrite").parquet(f"{root}/days/batch={batch_id}")
        kept = spark.read.parquet(f"{root}/days/batch={batch_id}").schema
        days = _batches(spark, f"{root}/days", kept, batch_id)
        newest = days.groupBy(*by, "block").agg(F.max("batch").alias("batch"))
        days = written(days.join(newest, [*by, "block", "batch"], "left_semi").drop("batch"), "days-now")

        reach = reg.bins * reg.bin_steps * reg.step_seconds + reg.bin_steps * reg.step_seconds
        ahead = changed.select(F.explode(F.array(F.col("timestamp"), shift(F.col("timestamp"), reach))).alias("day"))
        asked = written(reached_cutoffs(changed, in_months(ahead), reg, every, by), "asked")
        start = history_start(F.col("cutoff"), reg.bins, reg.bin_steps, reg.step_seconds)
        needed = asked.select(F.explode(F.array(F.col("cutoff"), start, shift(start, -1), F.least(F.col("knowledge"), shift(start, -1)))).alias("day"))
        made = snapshots_pit(in_months(needed).drop("batch", "month"), asked, reg, by, days)
        made.write.mode("overwrite").parquet(f"{root}/snapshots/batch={batch_id}")

    return run


def incremental_snapshots(stream: DataFrame, root: str, checkpoint: str, reg: Registry, every: int = 1, by: Sequence[str] = ("series",)) -> DataFrame:
    """Snapshots of all micro-batches there are now, with the ``batch`` that made them; older ones stay as they are."""
    stream.writeStream.foreachBatch(snapshot_batch(root, reg, every, by)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.option("basePath", f"{root}/snapshots").parquet(f"{root}/snapshots")
