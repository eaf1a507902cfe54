"""Registered queries: streaming jobs, run over all there is now and compared with the batch form in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import shared_path
from ..streaming import jobs as J
from ..streaming.incremental import incremental_snapshots
from .base import DEADBAND, OBS, PRED, REGISTRY, STEP, canonical_sql, ms, observations, predictions, query, r4, realised


def in_batches(df, name, count, files=4):
    """A file stream of ``count`` micro-batches, by the column ``batch``: so many files each, written one batch after another."""
    spark = df.sparkSession
    path, own = shared_path(spark, name), df.drop("batch")
    for i in range(count):
        df.where(F.col("batch") == i).drop("batch").repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(own.schema).option("maxFilesPerTrigger", files).parquet(path)


def thirds(df, time, ends=None):
    """Add ``batch``: 0 to 2 by time, between the ends of the table or those given."""
    t = F.unix_millis(time)
    lo, hi = ends or df.agg(F.min(t), F.max(t)).first()
    return df.withColumn("batch", F.greatest(F.lit(0), F.least(F.lit(2), F.floor(3 * (t - lo) / (hi - lo + 1)).cast("int"))))


def _run(stream, name):
    spark = stream.sparkSession
    return J.drain(stream, shared_path(spark, f"{name}-checkpoint"), shared_path(spark, f"{name}-out"))


@query("st1_st6_dedup", f"WITH {OBS} SELECT event_id FROM obs")
def _(spark, sf):
    """Each row twice, the second time a batch later."""
    o = thirds(observations(spark, sf).select("event_id", "ingested_at", "series"), "ingested_at")
    twice = o.unionByName(o.withColumn("batch", F.col("batch") + 1))
    return _run(J.deduplicated(in_batches(twice, "polls", 4)), "dedup").select("event_id")


#: Rows of the last twelve hours of a batch that come with the next one, and rows of the first batch that come with the third.
_THIRDS = f"""b AS (SELECT *, 3 * (epoch_ms(t) - lo) // (hi - lo + 1) AS third, lo + (hi - lo + 1) * (3 * (epoch_ms(t) - lo) // (hi - lo + 1) + 1) // 3 AS ends, hi FROM obs, (SELECT epoch_ms(min(t)) AS lo, epoch_ms(max(t)) AS hi FROM obs)),
 told AS (SELECT *, third = 0 AND CAST(event_id AS BIGINT) % 41 = 0 AND epoch_ms(t) < ends - 3 * 86400000 AS behind FROM b)"""


@query(
    "st3_stateful_hysteresis",
    f"""WITH {OBS}, {_THIRDS}, can AS (SELECT series, t, arg_max(v, rv) AS v, any_value(hi) AS hi FROM told WHERE NOT behind GROUP BY 1, 2),
    s AS (SELECT *, last_value(CASE WHEN v > 10 THEN 1 WHEN v < -10 THEN -1 END IGNORE NULLS) OVER (PARTITION BY series ORDER BY t) AS sign FROM can),
    c AS (SELECT *, CASE WHEN sign IS DISTINCT FROM lag(sign) OVER (PARTITION BY series ORDER BY t) THEN t END AS ch FROM s)
    SELECT series, epoch_ms(t) AS t_ms, round(v, 4) + 0.0 AS v, CAST(sign AS INTEGER) AS sign, epoch_ms(last_value(ch IGNORE NULLS) OVER (PARTITION BY series ORDER BY t)) AS since_ms, false AS late FROM c QUALIFY epoch_ms(t) <= hi - 86400000
    UNION ALL SELECT series, epoch_ms(t), round(v, 4) + 0.0, NULL, NULL, true FROM told WHERE behind""",
)
def _(spark, sf):
    """All revisions in three batches: some a batch late, inside the delay, and stepped in order; some two batches late, and marked."""
    o = observations(spark, sf).select("series", "timestamp", "system_imbalance_mw", "row_version", "event_id")
    t = F.unix_millis("timestamp")
    lo, hi = o.agg(F.min(t), F.max(t)).first()
    third = F.floor(3 * (t - lo) / (hi - lo + 1)).cast("int")
    ends = lo + F.floor((hi - lo + 1) * (third + 1) / 3)
    i = F.col("event_id").cast("bigint")
    behind, held = (third == 0) & (i % 41 == 0) & (t < ends - 3 * 86_400_000), (third < 2) & (i % 3 == 0) & (t >= ends - 43_200_000)
    batch = F.when(behind, 2).when(held, third + 1).otherwise(third)
    stream = in_batches(o.withColumn("batch", batch).drop("event_id"), "revisions", 3)
    out = _run(J.stateful_states(stream, DEADBAND, "24 hours", "row_version"), "states")
    return out.select("series", ms("timestamp", "t_ms"), r4("system_imbalance_mw", "v"), F.col("state_sign").alias("sign"), ms("state_since", "since_ms"), "late")


@query(
    "st4_outcome_stream",
    f"WITH {PRED}, real AS (SELECT series, t, arg_max({{'e': event_id, 'a': ingested_at}}, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS r FROM obs GROUP BY 1, 2) SELECT p.event_id, r.e AS realized_event_id FROM predc p JOIN real ON real.series = p.series AND real.t = p.target_time AND p.generated_at <= r.a",
)
def _(spark, sf):
    from ..operators.pit import canonical_predictions

    """Both streams in three batches; predictions of a batch's last step meet their value in the next one."""
    real = realised(spark, sf).select("series", "timestamp", "realized_event_id", "available_at")
    ends = tuple(real.agg(F.min(F.unix_millis("timestamp")), F.max(F.unix_millis("timestamp"))).first())
    p = in_batches(thirds(canonical_predictions(predictions(spark, sf)).select("event_id", "series", "target_time", "generated_at"), "target_time", ends), "predictions", 3)
    r = in_batches(thirds(real, "timestamp", ends), "realised", 3)
    return _run(J.outcome_stream(p, r), "outcomes").select("event_id", "realized_event_id")


@query("st7_live_bins", f"""{canonical_sql()}, b AS (SELECT series, ((epoch_ms(t) // 1000 - {STEP}) // {12 * STEP}) * {12 * STEP}000 + {12 * STEP}000 AS bin_end_ms, round(avg(v), 4) + 0.0 AS mean, count(*) AS observed, max(t) AS last FROM can GROUP BY 1, 2), e AS (SELECT max(t) AS hi FROM can)
SELECT series, bin_end_ms, mean, observed FROM b, e WHERE bin_end_ms + {STEP}000 <= epoch_ms(hi) - 3600000""")
def _(spark, sf):
    from ..operators.pit import canonical_latest

    c = canonical_latest(observations(spark, sf)).select("series", "timestamp", "system_imbalance_mw")
    out = _run(J.live_bins(in_batches(thirds(c, "timestamp"), "steps", 3), 12, STEP), "bins")
    return out.select("series", ms("bin_end", "bin_end_ms"), r4("mean", "mean"), "observed")




_SIZE, _EVERY = REGISTRY.bin_steps * STEP, 12
_DELIVERED = f"""{OBS}, every AS (SELECT series, t, v, ingested_at, event_id, rv FROM obs UNION ALL SELECT series, t, -v, ingested_at + INTERVAL 14 DAY, event_id || 'c', rv + CAST(1209600000 AS BIGINT) * 1048576 FROM obs WHERE CAST(event_id AS BIGINT) % 97 = 0),
 e AS (SELECT *, least(2, 3 * (epoch_ms(ingested_at) - lo) // (hi - lo + 1)) AS batch FROM every, (SELECT epoch_ms(min(ingested_at)) AS lo, epoch_ms(max(ingested_at)) AS hi FROM obs))"""


@query(
    "st5_incremental_snapshots",
    f"""WITH {_DELIVERED}, ch AS (SELECT DISTINCT series, t, ingested_at, batch FROM e),
    near AS (SELECT series, t, ingested_at, batch, unnest(generate_series(((epoch_ms(t) // 1000 + {_EVERY * STEP} - 1) // {_EVERY * STEP}) * {_EVERY * STEP}, epoch_ms(t) // 1000 + {_SIZE * (REGISTRY.bins + 1)}, {_EVERY * STEP})) AS c FROM ch),
    req AS (SELECT series, make_timestamp(c * 1000000) AS cutoff, batch, max(ingested_at) AS k FROM near WHERE (c // {_SIZE}) * {_SIZE} - {(REGISTRY.bins * REGISTRY.bin_steps - 1) * STEP} <= epoch_ms(t) // 1000 GROUP BY 1, 2, 3),
    ask AS (SELECT * FROM req WHERE EXISTS (SELECT 1 FROM e WHERE e.series = req.series AND e.t = req.cutoff AND e.batch <= req.batch)),
    seen AS (SELECT a.series, a.cutoff, a.batch, o.t, arg_max(o.v, o.rv) AS v FROM ask a JOIN e o ON o.series = a.series AND o.batch <= a.batch AND o.ingested_at <= a.k AND o.t <= a.cutoff AND o.t > a.cutoff - INTERVAL {REGISTRY.local_steps * STEP} SECOND GROUP BY 1, 2, 3, 4)
    SELECT a.series, epoch_ms(a.cutoff) AS cutoff_ms, epoch_ms(a.k) AS knowledge_ms, CAST(a.batch AS INTEGER) AS batch, count(s.t) AS observed, round(coalesce(sum(s.v), 0), 2) + 0.0 AS total, round(max(CASE WHEN s.t = a.cutoff THEN s.v END), 4) + 0.0 AS latest
    FROM ask a LEFT JOIN seen s ON s.series = a.series AND s.cutoff = a.cutoff AND s.batch = a.batch GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    """Observations in three batches by their time of ingestion, with corrections two weeks late: each batch makes the snapshots it reaches."""
    o = observations(spark, sf)
    shift_ms = 14 * 86_400_000
    late = o.where(F.col("event_id").cast("bigint") % 97 == 0)
    changes = {"system_imbalance_mw": -F.col("system_imbalance_mw"), "ingested_at": F.timestamp_millis(F.unix_millis("ingested_at") + shift_ms), "event_id": F.concat("event_id", F.lit("c")), "row_version": F.col("row_version") + shift_ms * 1048576}
    k = F.unix_millis("ingested_at")
    lo, hi = o.agg(F.min(k), F.max(k)).first()
    batch = F.least(F.lit(2), F.floor(3 * (k - lo) / (hi - lo + 1)).cast("int"))
    least = o.groupBy(batch.alias("batch")).count().agg(F.min("count")).first()[0] or 0
    files = max(4, min(spark.sparkContext.defaultParallelism, least // 10_000))  # large batches are written and read by all tasks
    stream = in_batches(o.unionByName(late.withColumns(changes)).withColumn("batch", batch), "observed", 3, files)
    s = incremental_snapshots(stream, shared_path(spark, "snapshots"), shared_path(spark, "snapshots-checkpoint"), REGISTRY, _EVERY)
    width = len(REGISTRY.local)
    total = F.aggregate(F.filter("local_values", lambda x, i: i % width == 0), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return s.select("series", ms("cutoff", "cutoff_ms"), ms("knowledge", "knowledge_ms"), F.col("batch").cast("int").alias("batch"), F.col("observed").cast("bigint").alias("observed"), (F.round(total, 2) + 0.0).alias("total"), r4("latest", "latest"))
