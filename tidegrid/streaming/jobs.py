"""Structured Streaming jobs over the event log."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.scalars import shift
from ..functions.scratch import workers_find_package
from ..operators.routing import EVENT_TABLES, ingest_counters, route, stored_triggers, typed_rows
from ..sources.sinks import CODEC, batch_path, commit_batch, dead_letters, is_committed, raw_rows, read_committed, write_typed

DEDUP_WINDOW = "2 hours"


def deduplicated(stream: DataFrame, time: str = "ingested_at", key: str = "event_id", window: str = DEDUP_WINDOW) -> DataFrame:
    """Each event id once inside the window, as a broker with message ids would publish it."""
    return stream.withWatermark(time, window).dropDuplicatesWithinWatermark([key])


def polled(spark: SparkSession, path: str, schema, lookback: str = "1 hour", glob: str | None = None, time: str = "ingested_at", key: str = "event_id") -> DataFrame:
    """Overlapping polls as a file stream: what a later poll repeats inside its look-back is dropped."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return deduplicated(reader.parquet(path), time, key, lookback)


def sink_batch(root: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch of envelopes: audit rows, typed rows, dead letters, stored triggers and counters, in a folder of its own that is committed last.

    Readers see committed batches only.  A batch that is delivered again after its commit is left as it is; one that broke off
    overwrites its own folder, so at-least-once delivery leaves no duplicates and no halves.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, root, batch_id):
            return
        own = lambda df, name: df.write.mode("overwrite").option("compression", CODEC).parquet(batch_path(root, name, batch_id))
        routed = route(batch).persist()
        try:
            good = routed.where("reason is null").select(*batch.columns)
            own(ingest_counters(routed), "counters")
            kinds = [r["event_type"] for r in routed.where("reason is null").select("event_type").distinct().collect()]  # seven types at most
            write_typed(good, "raw_events", root, "overwrite", batch_id, raw_rows)
            for kind in kinds:
                write_typed(typed_rows(routed, kind), EVENT_TABLES[kind], root, "overwrite", batch_id)
            own(dead_letters(routed.where("reason is not null").select(*batch.columns, "reason")), "dead_letters")
            own(stored_triggers(good.where("event_type = 'elia.imbalance.observed'")), "triggers")
            commit_batch(spark, root, batch_id, ["raw_events", "dead_letters", "triggers", "counters", *(EVENT_TABLES[k] for k in kinds)])
        finally:
            routed.unpersist()

    return run


def stored_counters(spark: SparkSession, root: str) -> DataFrame:
    """Published and rejected envelopes of each source and dataset, from what the committed batches counted when they stored them."""
    return read_committed(spark, "counters", root).groupBy("source", "dataset").agg(F.sum("published").alias("published"), F.sum("errors").alias("errors"))


def start_sink(envelopes: DataFrame, root: str, checkpoint: str):
    """The ids inside the dedup window are kept on disk by tasks, not in their heap; they aren't looked up a second time to be counted."""
    conf = envelopes.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return deduplicated(envelopes).writeStream.foreachBatch(sink_batch(root)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_OUT = "series string, timestamp timestamp, system_imbalance_mw double, state_sign int, state_since timestamp, last_observed_at timestamp, late boolean"
_HELD = "at bigint, value double, rank bigint"
_STATE = "sign int, since bigint, last bigint"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class OrderedStates(StatefulProcessor):
    """Confirmed state of a series whose rows come late: rows wait until the watermark has passed them and are stepped in order.

    A map by time holds the rows that wait, so that of several revisions of a step the one of highest rank is stepped; those of one
    micro-batch are compared first, so that state is asked once for a step and not for each revision.  A value holds the sign, since
    when, and the last step.  A timer at a step's time fires once the watermark is beyond it.  Rows at or
    before the last step can't be stepped any more: they come out at once, marked late, without a state.
    """

    def __init__(self, deadband: float):
        self.deadband = deadband

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "at bigint", _HELD)
        self.state = handle.getValueState("state", _STATE)

    def _now(self) -> tuple:
        return self.state.get() if self.state.exists() else (None, None, None)

    @staticmethod
    def _frame(key: tuple, rows: list[tuple]) -> pd.DataFrame:
        at = lambda us: None if us is None else pd.Timestamp(us, unit="us")
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        return pd.DataFrame({
            "series": [key[0]] * len(rows), "timestamp": pd.Series([at(x) for x in cols[0]], dtype="datetime64[us]"), "system_imbalance_mw": pd.Series(cols[1], dtype="float64"), "state_sign": pd.Series(cols[2], dtype="Int32"),
            "state_since": pd.Series([at(x) for x in cols[3]], dtype="datetime64[us]"), "last_observed_at": pd.Series([at(x) for x in cols[4]], dtype="datetime64[us]"), "late": pd.Series(cols[5], dtype="bool"),
        })

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self._now()[2]
        best = None  # of each step, the first row of highest rank
        for pdf in rows:
            own = pd.DataFrame({"at": pdf["timestamp"].astype("datetime64[us]").astype("int64"), "value": pdf["system_imbalance_mw"], "rank": pdf["rank"]})
            if last is not None:
                behind = own["at"] <= last
                if behind.any():
                    yield self._frame(key, [(at, value, None, None, None, True) for at, value in own.loc[behind, ["at", "value"]].itertuples(index=False, name=None)])
                own = own[~behind]
            both = own if best is None else pd.concat([best, own])
            best = both.sort_values("rank", ascending=False, kind="stable").drop_duplicates("at")
        for at, value, rank in () if best is None else zip(best["at"].tolist(), best["value"].tolist(), best["rank"].tolist(), strict=True):
            mine = (at,)
            if not self.held.containsKey(mine):
                self.handle.registerTimer(-(-at // 1000))
            elif self.held.getValue(mine)[2] >= rank:
                continue
            self.held.updateValue(mine, (at, value, rank))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = expiredTimerInfo.getExpiryTimeInMs() * 1000
        ready = sorted(v for _, v in self.held.iterator() if v[0] <= passed)
        sign, since, last = self._now()
        out = []
        for at, value, _ in ready:
            own = 1 if value > self.deadband else -1 if value < -self.deadband else sign
            if own != sign:
                sign, since = own, at
            last = at
            out.append((at, value, sign, since, last, False))
            self.held.removeKey((at,))
        if out:
            self.state.update((sign, since, last))
            yield self._frame(key, out)

    def close(self) -> None:
        pass


def stateful_states(stream: DataFrame, deadband: float, delay: str = "0 seconds", rank: str | None = None) -> DataFrame:
    """Confirmed state of each series in order of time, carried from batch to batch; rows up to ``delay`` behind the newest may come in any order.

    State of a series is its rows within the delay and one row more.  A row comes out when the watermark has passed it; of rows of one
    step, that of the highest ``rank`` (a long) counts.  Rows behind what was stepped come out with ``late`` set and no state, for
    ``changed_steps``: they ask for snapshots of their own and change no state that was given out.
    """
    spark = stream.sparkSession
    workers_find_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)  # what transformWithState needs
    order = F.coalesce(F.col(rank).cast("bigint"), F.lit(-(1 << 63))) if rank else F.lit(0).cast("bigint")
    # the watermark stands on a copy that goes no further: rows behind it are marked, not dropped
    keyed = stream.withColumn("__clock", F.col("timestamp")).withWatermark("__clock", delay).select("series", "timestamp", "system_imbalance_mw", order.alias("rank"))
    return keyed.groupBy("series").transformWithStateInPandas(OrderedStates(deadband), _OUT, "Append", "EventTime")


def outcome_stream(predictions: DataFrame, realised: DataFrame, delay: str = "2 hours", span: str = "interval 2 hours", by: tuple[str, ...] = ("series",)) -> DataFrame:
    """Predictions and realisations of the same time and series, in either order, that were made before the value was available."""
    p = predictions.withWatermark("target_time", delay).alias("p")
    r = realised.withWatermark("timestamp", delay).alias("r")
    on = F.expr(f"p.target_time = r.timestamp AND p.generated_at <= r.available_at AND r.timestamp >= p.target_time - {span} AND r.timestamp <= p.target_time + {span}" + "".join(f" AND p.{c} = r.{c}" for c in by))
    return p.join(r, on, "inner").drop(*[F.col(f"r.{c}") for c in by])


def changed_steps(batch: DataFrame, by: tuple[str, ...] = ("series",)) -> DataFrame:
    """Snapshot requests of a batch's steps, each with its own knowledge time: late revisions re-trigger, older snapshots stay."""
    ids = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in by], F.col("timestamp").cast("string"), F.col("ingested_at").cast("string")), 256)
    return batch.select(ids.alias("request_id"), *by, F.col("timestamp").alias("cutoff"), F.col("ingested_at").alias("knowledge")).distinct()


def corrections(stream: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ("series",)) -> DataFrame:
    """Snapshot requests of all micro-batches, each batch in a folder of its own, so that a replay leaves no second ones.

    Nothing is taken back: a revision adds a request with its own knowledge time, and the older one stays.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        changed_steps(batch, by).write.mode("overwrite").parquet(f"{path}/batch={batch_id:010d}")

    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path).drop("batch")


def live_bins(stream: DataFrame, bin_steps: int = 15, step_seconds: int = 60, delay: str = "1 hour", by: tuple[str, ...] = ("series",)) -> DataFrame:
    """Right-closed bins as a live view: a bin comes out once the watermark has passed it."""
    size = bin_steps * step_seconds
    w = F.window("timestamp", f"{size} seconds", f"{size} seconds", f"{step_seconds} seconds")
    v = "system_imbalance_mw"
    out = stream.withWatermark("timestamp", delay).groupBy(*by, w.alias("w")).agg(F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_pop(v).alias("std"), F.count(v).alias("observed"))
    return out.select(*by, shift(F.col("w.start"), size - step_seconds).alias("bin_end"), "mean", "min", "max", "std", "observed")


def drain(stream: DataFrame, checkpoint: str, path: str) -> DataFrame:
    """Run an append stream over all there is now, to Parquet, and read the result."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
