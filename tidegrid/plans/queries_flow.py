"""Registered queries: the sink stream, corrections and polls, derived events, reconciliation, exports and checks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.scratch import shared_path, written
from ..functions.schemas import Registry
from ..operators import evaluate as E
from ..operators import forecast as M
from ..operators import pit as P
from ..operators import routing as T
from ..operators import splits as X
from ..sources import records as C
from ..sources import sinks as K
from ..streaming import jobs as J
from . import snapshots as N
from .base import CAN, DEADBAND, KNOWN, OBS, PRED, REGISTRY, STEP, events, ms, observations, predictions, query, r4
from ..operators.grid import select_cutoffs
from .comparison import compared, scored_models, simple_forecasts, split_examples
from .exports import examples_from_tables, export_from_csv
from .queries_core import snapshot_requests
from .queries_io import _REASON, _logged, _text, envelopes
from .queries_model import _EVAL, _GAP, _INIT, _OUT, outcomes

_SOURCE_ID = """sha256('["elia","ods161","' || CAST(event_id AS VARCHAR) || '","1"]')"""


@query("st2_sink_stream", " UNION ALL ".join(f"SELECT '{kind}' AS kind, {_SOURCE_ID} AS event_id, CAST(NULL AS VARCHAR) AS reason FROM events WHERE {_REASON} IS NULL" for kind in ("raw", "typed")) + f" UNION ALL SELECT 'dead' AS kind, {_SOURCE_ID}, {_REASON} FROM events WHERE {_REASON} IS NOT NULL")
def _(spark, sf):
    """All envelopes through the sink stream in two batches; then they are delivered a second time, and another batch breaks off: neither is read."""
    inbox = shared_path(spark, "inbox")
    root = _sunk(spark, sf, inbox, _PACKED)
    again = C.read_envelopes(spark, inbox)
    J.sink_batch(root)(again, 0)
    K.write_typed(T.typed_rows(T.route(again), "elia.imbalance.observed"), "imbalance_observations", root, batch=7)
    rows = lambda kind, name: K.read_committed(spark, name, root).select(F.lit(kind).alias("kind"), "event_id", F.lit(None).cast("string").alias("reason"))
    dead = K.read_committed(spark, "dead_letters", root).select(F.lit("dead").alias("kind"), F.col("original_event.event_id").alias("event_id"), "reason")
    return rows("raw", "raw_events").unionByName(rows("typed", "imbalance_observations")).unionByName(dead)


_PACKED = "gzip"  # an inbox of plain text is larger than all that the sink makes of it


def _sunk(spark, sf, inbox=None, codec="none"):
    """The root of a sink that has stored all envelopes, which lie in ``inbox``, in two batches."""
    inbox, root = inbox or shared_path(spark, "inbox"), shared_path(spark, "sink")
    e = envelopes(spark, sf, spark.sparkContext.defaultParallelism)  # a half is as many files as tasks can write, and a batch takes as many
    half = F.col("correlation_id").cast("bigint") % 2 == 0
    e.where(half).write.json(inbox, compression=codec)
    files = len(C.read_envelopes(spark, inbox).inputFiles())
    e.where(~half).write.mode("append").json(inbox, compression=codec)
    J.start_sink(C.read_envelopes(spark, inbox, streaming=True, files=files), root, shared_path(spark, "sink-checkpoint")).awaitTermination()
    return root


@query("evt11_stored_counters", f"WITH r AS (SELECT event_type AS dataset, {_REASON} AS reason FROM events) SELECT 'elia' AS source, dataset, count(*) - count(reason) AS published, count(reason) AS errors FROM r GROUP BY 2")
def _(spark, sf):
    """What the sink's own batches counted, after two batches and a replay of each."""
    root = _sunk(spark, sf, codec=_PACKED)
    for batch in (0, 1):
        J.sink_batch(root)(envelopes(spark, sf), batch)
    return J.stored_counters(spark, root)


@query("st5_late_corrections", f"WITH {OBS} SELECT DISTINCT series, epoch_ms(t) AS cutoff_ms, epoch_ms(ingested_at) AS knowledge_ms FROM obs")
def _(spark, sf):
    """A snapshot request for each revision of a step, late ones with their own knowledge time."""
    o = observations(spark, sf).select("series", "timestamp", "ingested_at")
    path = shared_path(spark, "revisions")
    o.write.parquet(path)
    asks = J.corrections(spark.readStream.schema(o.schema).parquet(path), shared_path(spark, "asks"), shared_path(spark, "asks-checkpoint"))
    return asks.select("series", ms("cutoff", "cutoff_ms"), ms("knowledge", "knowledge_ms")).distinct()


@query("st6_overlapping_polls", f"WITH {OBS} SELECT event_id, epoch_ms(ingested_at) AS ingested_ms FROM obs")
def _(spark, sf):
    """Polls of five days, each with the last hour of the one before; a file for each poll, as a source answers it."""
    o = observations(spark, sf).select("event_id", "series", "ingested_at")
    path, size = shared_path(spark, "polls"), 5 * 86400
    at = lambda seconds: F.floor((F.unix_seconds("ingested_at") + seconds) / size)
    own = o.withColumn("poll", F.explode(F.array_distinct(F.array(at(0), at(3600)))))
    first, last = own.agg(F.min("poll"), F.max("poll")).first()
    for poll in range(first, last + 1):  # polls follow the time span of the table, and come one after another
        own.where(F.col("poll") == poll).drop("poll").coalesce(1).write.mode("append").parquet(path)
    seen = J.drain(J.polled(spark, path, o.schema), shared_path(spark, "polls-checkpoint"), shared_path(spark, "polls-out"))
    return seen.select("event_id", ms("ingested_at", "ingested_ms"))


_HASH = REGISTRY.fingerprint()
_ISO = "strftime(evaluated_at, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(evaluated_at) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z'"


@query(
    "evt10_feature_prediction_outcome_events",
    f"""WITH {PRED}, {_OUT} SELECT 'imbalance.features.generated' AS event_type, sha256('["features","system-imbalance","' || event_id || ':{_HASH}","1"]') AS event_id, event_id AS causation_id FROM predc
    UNION ALL SELECT 'imbalance.prediction.generated', sha256('["predictor","system-imbalance","' || event_id || ':' || model_version || ':{_HASH}","1"]'), event_id FROM predc
    UNION ALL SELECT 'imbalance.prediction.evaluated', sha256('["outcome-joiner","prediction-outcome","' || event_id || ':' || realized_event_id || ':' || {_ISO} || '","1"]'), event_id FROM outc""",
)
def _(spark, sf):
    p = P.canonical_predictions(predictions(spark, sf)).withColumns({"trigger_id": F.col("event_id"), "feature_schema_hash": F.lit(_HASH), "prediction_quality": F.lit("model"), "created_at": F.col("generated_at")})
    made = [T.feature_events(p), T.prediction_events(p), T.outcome_events(outcomes(spark, sf))]
    a, b, c = [m.select("event_type", "event_id", "causation_id") for m in made]
    return a.unionByName(b).unionByName(c)


_LATE = CAN.replace("can AS", "late AS") % f"WHERE ingested_at <= TIMESTAMP '{KNOWN}'"


@query(
    "ml15_late_reconciliation",
    f"""WITH {PRED}, {_LATE} SELECT p.event_id AS prediction_event_id, r.event_id AS realized_event_id, epoch_ms(r.ingested_at) AS evaluated_ms, round(r.v, 4) + 0.0 AS value,
    CASE WHEN r.v > 10 THEN 'positive' WHEN r.v < -10 THEN 'negative' ELSE cs END AS realized_state FROM predc p JOIN late r ON r.series = p.series AND r.t = p.target_time AND p.generated_at <= r.ingested_at""",
)
def _(spark, sf):
    """Predictions against the latest revision known at one time."""
    r = M.reconcile(P.canonical_predictions(predictions(spark, sf)), observations(spark, sf), KNOWN, DEADBAND)
    return r.select("prediction_event_id", "realized_event_id", ms("evaluated_at", "evaluated_ms"), r4("realized_system_imbalance_mw", "value"), "realized_state")


_REQ = f"""WITH {OBS}, d AS (SELECT DISTINCT series, t FROM obs), n AS (SELECT series, t, lead(t) OVER (PARTITION BY series ORDER BY t) AS nx, min(t) OVER (PARTITION BY series) AS o FROM d),
 req AS (SELECT series, t AS cutoff, t + INTERVAL 5400 SECOND AS k FROM n WHERE epoch_ms(nx) - epoch_ms(t) = {STEP}000 AND ((epoch_ms(t) - epoch_ms(o)) // {STEP}000) % 6 = 0)"""


@query(
    "scl14_source_quality",
    f"""{_REQ}, seen AS (SELECT r.series, r.cutoff, arg_max(o.quality, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS q FROM req r JOIN obs o ON o.series = r.series AND o.t = r.cutoff AND o.ingested_at <= r.k GROUP BY 1, 2)
    SELECT r.series, epoch_ms(r.cutoff) AS cutoff_ms, CASE WHEN s.q IS NULL THEN -1 WHEN lower(s.q) = 'validated' THEN 1 ELSE 0 END AS quality_code FROM req r LEFT JOIN seen s ON s.series = r.series AND s.cutoff = r.cutoff""",
)
def _(spark, sf):
    """The code of each snapshot's last row, which the quality cohort takes."""
    s = N.snapshots_pit(observations(spark, sf), snapshot_requests(spark, sf), REGISTRY)
    return s.select("series", ms("cutoff", "cutoff_ms"), E.source_quality(F.col("local_values"), F.col("local_masks"), len(REGISTRY.local)).alias("quality_code"))


@query("fea2_fea3_equal", f"{_REQ} SELECT count(*) AS requests, CAST(0 AS BIGINT) AS differing FROM req")
def _(spark, sf):
    """Requests, and how many of them have another snapshot in the online form than in the replay."""
    asked = written(snapshot_requests(spark, sf), "requests")
    near = lambda c: F.transform(c, lambda x: F.round(x.cast("double"), 3) + 0.0)
    flat = lambda df: df.select("request_id", F.struct("model_eligible", "current_state", "observed", *[(near if g == "values" else F.col)(f"{p}_{g}").alias(f"{p}_{g}") for p in ("local", "context", "static") for g in ("values", "masks")]).alias("x"))
    obs = observations(spark, sf)
    online, replay = flat(N.snapshots(obs, asked, REGISTRY)), flat(N.snapshots_pit(obs, asked, REGISTRY)).withColumnRenamed("x", "y")
    both = asked.select("request_id").join(online, "request_id", "left").join(replay, "request_id", "left")
    same = F.col("x").isNotNull() & (F.to_json("x") == F.to_json("y"))
    return both.agg(F.count(F.lit(1)).alias("requests"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differing"))


_SMALL = Registry(local_steps=20, bin_steps=5, bins=4, min_observed=5)


@query(
    "fea6_export_from_csv",
    f"""WITH e AS (SELECT event_id AS i, CAST(value - 35 AS DECIMAL(18, 4)) AS v FROM events), l AS (SELECT i, v, lead(v) OVER (ORDER BY i) AS nx FROM e)
    SELECT CAST(1704067200000 + i * 60000 AS BIGINT) AS cutoff_ms, round(CAST(v AS DOUBLE), 3) + 0.0 AS latest, round(CAST(nx AS DOUBLE), 3) + 0.0 AS target_next FROM l WHERE i >= {_SMALL.history_steps + _SMALL.bin_steps - 1} AND i % 30 = 0 AND nx IS NOT NULL""",
)
def _(spark, sf):
    """Events as one value a minute in the portal's CSV, exported as a training set and read back."""
    e = events(spark, sf).select(F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") * 60).alias("t"), _text(F.col("value") - 35).alias("v"))
    own = {"Datetime": F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"), "Quarter hour": F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"), "Resolution code": F.lit("PT1M"), "Quality status": F.lit("Validated"), "System imbalance": F.col("v")}
    csv, path = shared_path(spark, "minutes"), shared_path(spark, "dataset")
    e.select(*[own.get(c, F.lit("")).alias(c) for c in C.CSV_COLUMNS]).write.csv(csv, sep=";", header=True)
    export_from_csv(spark, csv, path, _SMALL)
    d = spark.read.parquet(path)
    three = lambda c: (F.round(c, 3) + 0.0).alias(c)
    return d.select(ms("cutoff", "cutoff_ms"), three("latest"), three("target_next"))


def _examples(spark, sf):
    cutoffs = select_cutoffs(observations(spark, sf), 4, 3, by=["series"], step_seconds=STEP)
    return split_examples(examples_from_tables(observations(spark, sf), cutoffs, REGISTRY, ["series"], knowledge_lag=5400, check=False), _GAP, _EVAL, _INIT)


_TEST = f"""WITH {OBS}, d AS (SELECT DISTINCT series, t FROM obs), n AS (SELECT series, t, row_number() OVER (PARTITION BY series ORDER BY t) AS n, lead(t) OVER (PARTITION BY series ORDER BY t) AS nx, min(t) OVER (PARTITION BY series) AS o FROM d),
 run AS (SELECT *, row_number() OVER (PARTITION BY series, epoch_ms(t) - n * {STEP}000 ORDER BY t) AS len FROM n), req AS (SELECT series, t AS cutoff, t + INTERVAL 5400 SECOND AS k FROM run WHERE len >= 4 AND epoch_ms(nx) - epoch_ms(t) = {STEP}000 AND ((epoch_ms(t) - epoch_ms(o)) // {STEP}000) % 3 = 0),
 u AS (SELECT DISTINCT cutoff FROM req), e AS (SELECT max(cutoff) + min(step) AS e FROM (SELECT cutoff, lead(cutoff) OVER (ORDER BY cutoff) - cutoff AS step FROM u)),
 test AS (SELECT req.* FROM req, e WHERE cutoff >= e - INTERVAL 3 DAY AND cutoff < e), lab AS (SELECT series, t, arg_max(v, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS v FROM obs GROUP BY 1, 2),
 h AS (SELECT x.series, x.cutoff, o.t, CAST(CAST(arg_max(o.v, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS FLOAT) AS DOUBLE) AS v FROM test x JOIN obs o ON o.series = x.series AND o.t <= x.cutoff AND o.t > x.cutoff - INTERVAL {REGISTRY.local_steps * STEP} SECOND AND o.ingested_at <= x.k GROUP BY 1, 2, 3),
 r AS (SELECT *, row_number() OVER (PARTITION BY series, cutoff ORDER BY t DESC) AS back FROM h), p AS (SELECT series, cutoff, t, v, row_number() OVER (PARTITION BY series, cutoff ORDER BY t) - 1 AS i FROM r WHERE back <= 15),
 f AS (SELECT series, cutoff, arg_max(v, t) AS persistence, CASE WHEN count(*) < 2 THEN arg_max(v, t) ELSE least(max(v), greatest(min(v), regr_intercept(v, i) + regr_slope(v, i) * count(*))) END AS drift, median(v) AS med FROM p GROUP BY 1, 2),
 s AS (SELECT x.series, x.cutoff, l.v AS actual, unnest([{{'m': 'persistence', 'y': coalesce(persistence, 0)}}, {{'m': 'clipped_linear_drift', 'y': coalesce(drift, 0)}}, {{'m': 'rolling_median', 'y': coalesce(med, 0)}}]) AS f FROM test x JOIN lab l ON l.series = x.series AND l.t = x.cutoff + INTERVAL {STEP} SECOND LEFT JOIN f ON f.series = x.series AND f.cutoff = x.cutoff)"""


@query("ml17_baselines", f"{_TEST} SELECT f.m AS model, count(*) AS rows, round(avg(abs(f.y - actual)), 3) AS mae, round(sqrt(avg((f.y - actual) ** 2)), 3) AS rmse FROM s GROUP BY 1")
def _(spark, sf):
    """The three baselines that are no model, on the test section of the latest purged split."""
    test = simple_forecasts(_examples(spark, sf).where("split = 'test'"), REGISTRY)
    names = ("persistence", "clipped_linear_drift", "rolling_median")
    long = test.select("target_next", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("y")) for n in names])).alias("f")).select("target_next", "f.*")
    err = F.col("y") - F.col("target_next")
    return long.groupBy("model").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.abs(err)), 3).alias("mae"), F.round(F.sqrt(F.avg(err * err)), 3).alias("rmse"))


@query("ml17_comparison")
def _(spark, sf):
    """Candidate and four baselines, fitted on their sections and scored together; the decision stands beside each."""
    scored, threshold = scored_models(_examples(spark, sf), REGISTRY)
    reports, cohorts = compared(scored, threshold)
    reports = written(reports, "reports")
    decision = E.promotion_decision(reports, cohorts).select("promote", F.array_join("reasons", ",").alias("reasons"))
    return reports.select("model", "rows", *[r4(c, c) for c in ("mae", "rmse", "brier", "pr_auc", "interval_coverage")]).crossJoin(F.broadcast(decision))  # one row


@query("ml13_output_sanity", "SELECT event_id AS row_id, event_id % 8 = 0 OR (event_id % 8 = 6 AND user_id % 2 = 0) AS sane FROM events")
def _(spark, sf):
    """Forecasts made from the events, seven of eight with a fault: each kind of unsound output is told."""
    kind, v = F.col("event_id") % 8, F.col("value")
    bad = F.when(kind == 1, F.lit(None)).when(kind == 2, F.lit(float("nan"))).when(kind == 3, F.lit(float("inf"))).otherwise(v)
    state = F.when(kind != 7, "positive")
    other = F.when((kind == 6) & (F.col("user_id") % 2 == 0), "negative").otherwise("positive")
    rows = events(spark, sf).select(
        F.col("event_id").alias("row_id"), bad.alias("system_imbalance_mw"), (v + F.when(kind == 4, 3).otherwise(-1)).alias("p10_mw"), (v + 1).alias("p90_mw"), F.when(kind == 5, 1.5).otherwise(0.5).alias("flip_probability"),
        v.alias("delta_mw"), (kind >= 6).alias("will_flip"), state.alias("current_state"), other.alias("predicted_state"),
    )
    return rows.select("row_id", M.sane().alias("sane"))


_SECTIONS = """WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS t FROM events), b AS (SELECT min(t) AS lo, max(t) AS hi, min(d) AS step FROM (SELECT t, lead(t) OVER (ORDER BY t) - t AS d FROM h)), e AS (SELECT hi + step AS e FROM b),
 l AS (SELECT t, CASE WHEN t >= e - INTERVAL 3 DAY THEN 4 WHEN t >= e - INTERVAL 7 DAY AND t < e - INTERVAL 4 DAY THEN 3 WHEN t >= e - INTERVAL 11 DAY AND t < e - INTERVAL 8 DAY THEN 2 WHEN t < e - INTERVAL 12 DAY THEN 1 END AS s FROM h, e),
 s AS (SELECT s, min(t) AS f, max(t) AS z FROM l WHERE s IS NOT NULL GROUP BY 1), g AS (SELECT count(*) + 1 AS n, min(gap) AS gap FROM (SELECT b.f - a.z AS gap FROM s a JOIN s b ON b.s = a.s + 1))"""


@query("ml3_split_validation", f"{_SECTIONS} SELECT 'own gap' AS name, n = 4 AND gap >= INTERVAL 1 DAY AS valid FROM g UNION ALL SELECT 'wider gap', n = 4 AND gap >= INTERVAL 2 DAY FROM g UNION ALL SELECT 'no calibration', false FROM g")
def _(spark, sf):
    """Whether the latest split passes its check with its own gap, with a wider one, and without one of its sections."""
    h = events(spark, sf).select(F.date_trunc("HOUR", "ts").alias("cutoff")).distinct()
    split = written(X.latest_purged_split(h, gap=_GAP, evaluation=_EVAL, initial=_INIT), "split")

    def valid(df, gap):
        try:
            X.validate_split(df, gap=gap)
        except ValueError:
            return False
        return True

    cases = [("own gap", valid(split, _GAP)), ("wider gap", valid(split, timedelta(days=2))), ("no calibration", valid(split.where("split <> 'calibration'"), _GAP))]
    return spark.createDataFrame(cases, "name string, valid boolean")


@query("scl3_dst_flag", "WITH e AS (SELECT event_id, ts + INTERVAL 75 DAY AS c FROM events) SELECT event_id, CASE WHEN c > TIMESTAMP '2024-03-31 00:00:00' - INTERVAL 1 MICROSECOND AND c < TIMESTAMP '2024-03-31 02:00:00' THEN 1.0 ELSE 0.0 END AS dst FROM e")
def _(spark, sf):
    """Events moved to the weeks around the change of the clocks on 31 March 2024, 01:00 UTC."""
    e = events(spark, sf).select("event_id", S.shift(F.col("ts"), 75 * 86400).alias("cutoff"))
    return e.select("event_id", S.calendar(F.col("cutoff"))["is_dst_transition"].alias("dst"))
