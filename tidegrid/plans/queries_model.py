"""Registered queries: forecasts, outcomes, labels, splits, evaluation and serving."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import evaluate as E
from ..operators import forecast as M
from ..operators import labels as L
from ..operators import pit as P
from ..operators import ranks as R
from ..operators import serving as V
from ..operators import splits as X
from ..operators.isotonic import calibrate, isotonic_fit
from ..operators.windows import sign_of
from .base import DEADBAND, OBS, PRED, SCORED, STEP, canonical_sql, events, ms, observations, predictions, query, r4, realised, scored, table

_PCOLS = "event_id, epoch_ms(target_time) AS target_ms, round(v, 4) + 0.0 AS v, round(p, 4) AS p, model_version, cs AS current_state"


def _pcols(df):
    return df.select("event_id", ms("target_time", "target_ms"), r4("system_imbalance_mw", "v"), r4("flip_probability", "p"), "model_version", "current_state")


@query("agg3_canonical_predictions", f"WITH {PRED} SELECT {_PCOLS} FROM predc")
def _(spark, sf):
    return _pcols(P.canonical_predictions(predictions(spark, sf)))


@query("srt1_latest_prediction", f"WITH {PRED} SELECT {_PCOLS} FROM pred ORDER BY target_time DESC, rv DESC, generated_at DESC, event_id DESC LIMIT 1")
def _(spark, sf):
    return _pcols(V.latest_prediction(predictions(spark, sf)))


@query(
    "srt2_prediction_page",
    f"WITH {PRED} SELECT {_PCOLS} FROM predc WHERE target_time >= TIMESTAMP '2024-01-05' AND target_time < TIMESTAMP '2024-01-25' AND (target_time > TIMESTAMP '2024-01-07' OR (target_time = TIMESTAMP '2024-01-07' AND event_id > 'error')) ORDER BY target_time, event_id LIMIT 101",
)
def _(spark, sf):
    return _pcols(V.prediction_page(predictions(spark, sf), "2024-01-05", "2024-01-25", 100, ("2024-01-07 00:00:00", "error")))


@query("srt3_predictions_for_target", f"WITH {PRED} SELECT {_PCOLS} FROM predc WHERE target_time = TIMESTAMP '2024-01-10 04:00:00'")
def _(spark, sf):
    return _pcols(V.predictions_for_target(predictions(spark, sf), "2024-01-10 04:00:00"))


_REAL = """real AS (SELECT series, t, arg_max({'e': event_id, 'v': v, 'a': ingested_at}, {'a': rv, 'b': ingested_at, 'c': event_id}) AS r FROM obs GROUP BY 1, 2)"""
_OUT = f"""{_REAL}, outc AS (SELECT p.event_id, p.target_time, r.e AS realized_event_id, r.v AS rv_value, CASE WHEN r.v > 10 THEN 'positive' WHEN r.v < -10 THEN 'negative' ELSE cs END AS rs, cs AS was, r.a AS evaluated_at
 FROM predc p JOIN real ON real.series = p.series AND real.t = p.target_time AND p.generated_at <= r.a)"""


def outcomes(spark, sf):
    joined = P.realised_join(P.canonical_predictions(predictions(spark, sf)), realised(spark, sf), ["series"])
    return M.evaluate_outcomes(joined, DEADBAND)


@query("jn4_ml14_outcomes", f"WITH {PRED}, {_OUT} SELECT event_id, epoch_ms(target_time) AS target_ms, realized_event_id, round(rv_value, 4) + 0.0 AS value, rs AS realized_state, was <> rs AS flip_actual, epoch_ms(evaluated_at) AS evaluated_ms FROM outc")
def _(spark, sf):
    return outcomes(spark, sf).select(F.col("prediction_event_id").alias("event_id"), ms("target_time", "target_ms"), "realized_event_id", r4("realized_system_imbalance_mw", "value"), "realized_state", "flip_actual", ms("evaluated_at", "evaluated_ms"))


def _with_versions(df):
    return df.withColumn("row_version", F.unix_millis("evaluated_at"))


_PS = "CASE WHEN p >= 0.5 AND cs IS NOT NULL THEN CASE cs WHEN 'positive' THEN 'negative' ELSE 'positive' END ELSE cs END"
_DASH = f"""WITH {PRED}, {_OUT}, dash AS (SELECT p.event_id, p.target_time, p.v, {_PS} AS ps, o.rs, o.rv_value, p.v - o.rv_value AS err FROM predc p LEFT JOIN outc o ON o.event_id = p.event_id AND o.target_time = p.target_time)"""


@query(
    "agg4_jn3_srt4_dashboard",
    f"{_DASH} SELECT event_id, epoch_ms(target_time) AS target_ms, CASE WHEN ps IS NULL OR rs IS NULL THEN 'pending' WHEN ps = rs THEN 'correct' ELSE 'incorrect' END AS badge, round(err, 4) + 0.0 AS err FROM dash WHERE target_time >= TIMESTAMP '2024-01-05' AND target_time <= TIMESTAMP '2024-01-12' ORDER BY target_time, event_id LIMIT 500",
)
def _(spark, sf):
    d = V.dashboard_rows(predictions(spark, sf), _with_versions(outcomes(spark, sf)), "2024-01-05", "2024-01-12")
    return d.select("event_id", ms("target_time", "target_ms"), "badge", r4("forecast_error", "err"))


@query(
    "agg18_dashboard_summary",
    f"""{_DASH} SELECT round(arg_max(v, {{'a': target_time, 'b': event_id}}), 4) + 0.0 AS latest, round(arg_max(rv_value, {{'a': target_time, 'b': event_id}}) FILTER (WHERE rv_value IS NOT NULL), 4) + 0.0 AS realised,
    round(least(min(v), min(rv_value)), 4) + 0.0 AS lo, round(greatest(max(v), max(rv_value)), 4) + 0.0 AS hi, count(*) AS n FROM dash""",
)
def _(spark, sf):
    o = P.with_outcomes(predictions(spark, sf), _with_versions(outcomes(spark, sf))).withColumn("forecast_error", F.col("system_imbalance_mw") - F.col("realized_system_imbalance_mw"))
    s = V.dashboard_summary(o)
    return s.select(r4("latest_prediction", "latest"), r4("latest_realised", "realised"), r4("least", "lo"), r4("greatest", "hi"), F.col("rows").alias("n"))


@query("srt5_current_model", "SELECT o_orderstatus AS family, arg_max(o_orderkey, {'a': o_orderdate, 'b': o_orderkey}) AS model FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1")
def _(spark, sf):
    m = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("family"), F.col("o_orderkey").alias("model"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("promoted_at"), F.col("o_orderkey").alias("row_version"))
    return V.current_model(m, ["family"]).select("family", "model")


@query("srt6_bounded_sample")
def _(spark, sf):
    return V.bounded_sample(observations(spark, sf), 512).select("event_id")


@query("srt6_sample_laws", f"WITH {OBS} SELECT least(512, count(*)) AS n, least(512, count(*)) AS ids, CAST(0 AS BIGINT) AS foreign_rows FROM obs")
def _(spark, sf):
    """What SQL can say of a sample: its size, that no row is drawn twice, and that all are rows of the table."""
    o = observations(spark, sf)
    s = V.bounded_sample(o, 512).select("event_id")
    known = s.join(o.select("event_id").distinct().withColumn("known", F.lit(1)), "event_id", "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"), F.count_if(F.col("known").isNull()).alias("foreign_rows"))


@query("jn6_fea4_labels", f"{canonical_sql()} SELECT c.series, epoch_ms(c.t) AS t_ms, round(a.v, 4) + 0.0 AS v1, round(b.v, 4) + 0.0 AS v2, round(d.v, 4) + 0.0 AS v5, round(e.v, 4) + 0.0 AS v10, round(a.v - c.v, 4) + 0.0 AS delta FROM can c JOIN can a ON a.series = c.series AND a.t = c.t + INTERVAL {STEP} SECOND LEFT JOIN can b ON b.series = c.series AND b.t = c.t + INTERVAL {2 * STEP} SECOND LEFT JOIN can d ON d.series = c.series AND d.t = c.t + INTERVAL {5 * STEP} SECOND LEFT JOIN can e ON e.series = c.series AND e.t = c.t + INTERVAL {10 * STEP} SECOND")
def _(spark, sf):
    c = P.canonical_latest(observations(spark, sf))
    snaps = c.select("series", F.col("timestamp").alias("cutoff"), F.col("system_imbalance_mw").alias("latest"), S.state_name(sign_of(F.col("system_imbalance_mw"), DEADBAND)).alias("current_state"))
    e = L.training_examples(snaps, c, DEADBAND, ["series"], STEP)
    aux = lambda i: F.when(F.get("auxiliary_mask", F.lit(i)) == 1, F.get("auxiliary_target", F.lit(i)))
    return e.select("series", ms("cutoff", "t_ms"), r4("target_next", "v1"), r4(aux(0), "v2"), r4(aux(1), "v5"), r4(aux(2), "v10"), r4("target_delta", "delta"))


@query(
    "agg9_scl10_fea7_scaling",
    """WITH l AS (SELECT event_id, event_type AS channel, value, CASE WHEN user_id % 4 <> 0 THEN 1 ELSE 0 END AS mask FROM events), q AS (SELECT channel, quantile_cont(value, 0.5) FILTER (WHERE mask = 1) AS loc, greatest(1e-6, quantile_cont(value, 0.75) FILTER (WHERE mask = 1) - quantile_cont(value, 0.25) FILTER (WHERE mask = 1)) AS sc FROM l GROUP BY 1)
    SELECT event_id, channel, round(CASE WHEN mask = 1 THEN least(12, greatest(-12, (value - loc) / sc)) ELSE 0 END, 4) + 0.0 AS scaled FROM l JOIN q USING (channel)""",
)
def _(spark, sf):
    long = events(spark, sf).select("event_id", F.col("event_type").alias("channel"), "value", (F.col("user_id") % 4 != 0).cast("int").alias("mask"))
    return L.apply_scaler(long, L.fit_scaler(long)).select("event_id", "channel", r4("scaled", "scaled"))


@query(
    "agg10_channel_summary",
    """WITH l AS (SELECT vec_id, (i - 1) % 8 AS channel, (i - 1) // 8 AS place, CAST(embedding[i] AS DOUBLE) AS v, CASE WHEN embedding[i] > -0.05 THEN 1 ELSE 0 END AS m FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))
    SELECT vec_id, CAST(channel AS INTEGER) AS channel, round(coalesce(arg_max(v, place) FILTER (WHERE m = 1), 0), 4) + 0.0 AS last, round(coalesce(avg(v) FILTER (WHERE m = 1), 0), 4) + 0.0 AS mean, round(coalesce(stddev_pop(v) FILTER (WHERE m = 1), 0), 4) + 0.0 AS std,
    round(coalesce(arg_max(v, place) FILTER (WHERE m = 1) - arg_min(v, place) FILTER (WHERE m = 1), 0), 4) + 0.0 AS change, round((count(*) FILTER (WHERE m = 1)) / count(*), 4) AS coverage FROM l GROUP BY 1, 2""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double"))).withColumn("m", F.transform("embedding", lambda x: (x > -0.05).cast("int")))
    s = L.channel_summary(L.channels(e, "v", "m", 8, ["vec_id"]), ["vec_id"])
    return s.select("vec_id", F.col("channel").cast("int").alias("channel"), *[r4(c, c) for c in ("last", "mean", "std", "change", "coverage")])


_GAP, _EVAL, _INIT = timedelta(days=1), timedelta(days=3), timedelta(days=10)


@query(
    "ml1_ml3_latest_split",
    """WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS t FROM events), b AS (SELECT min(t) AS lo, max(t) AS hi, min(d) AS step FROM (SELECT t, lead(t) OVER (ORDER BY t) - t AS d FROM h)), e AS (SELECT lo, hi + step AS e FROM b),
    l AS (SELECT t, CASE WHEN t >= e - INTERVAL 3 DAY AND t < e THEN 'test' WHEN t >= e - INTERVAL 7 DAY AND t < e - INTERVAL 4 DAY THEN 'calibration' WHEN t >= e - INTERVAL 11 DAY AND t < e - INTERVAL 8 DAY THEN 'validation' WHEN t < e - INTERVAL 12 DAY THEN 'train' END AS split FROM h, e)
    SELECT split, epoch_ms(min(t)) AS first_ms, epoch_ms(max(t)) AS last_ms, count(*) AS n FROM l WHERE split IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    h = events(spark, sf).select(F.date_trunc("HOUR", "ts").alias("cutoff")).distinct()
    s = X.split_sections(X.latest_purged_split(h, gap=_GAP, evaluation=_EVAL, initial=_INIT))
    return s.select("split", ms("first", "first_ms"), ms("last", "last_ms"), F.col("rows").alias("n"))


@query(
    "ml2_walk_forward",
    """WITH o AS (SELECT min(date_trunc('hour', ts)) AS lo FROM events), k AS (SELECT k, lo, lo + to_days(CAST(10 + 12 * k AS INTEGER)) AS o FROM o, range(1) AS r(k)),
    f AS (SELECT k, 'train' AS split, lo AS a, o AS b FROM k UNION ALL SELECT k, 'validation', o + INTERVAL 1 DAY, o + INTERVAL 4 DAY FROM k UNION ALL SELECT k, 'calibration', o + INTERVAL 5 DAY, o + INTERVAL 8 DAY FROM k UNION ALL SELECT k, 'test', o + INTERVAL 9 DAY, o + INTERVAL 12 DAY FROM k)
    SELECT event_id, CAST(k AS INTEGER) AS fold, split FROM events JOIN f ON date_trunc('hour', ts) >= a AND date_trunc('hour', ts) < b""",
)
def _(spark, sf):
    e = events(spark, sf).select("event_id", F.date_trunc("HOUR", "ts").alias("cutoff"))
    return X.walk_forward(e, 1, gap=_GAP, evaluation=_EVAL, initial=_INIT).select("event_id", "fold", "split")


@query(
    "ml2_walk_forward_two_folds",
    """WITH o AS (SELECT min(date_trunc('hour', ts)) AS lo FROM events), k AS (SELECT k, lo, lo + to_days(CAST(6 + 9 * k AS INTEGER)) AS o FROM o, range(2) AS r(k)),
    f AS (SELECT k, 'train' AS split, lo AS a, o AS b FROM k UNION ALL SELECT k, 'validation', o + INTERVAL 1 DAY, o + INTERVAL 3 DAY FROM k UNION ALL SELECT k, 'calibration', o + INTERVAL 4 DAY, o + INTERVAL 6 DAY FROM k UNION ALL SELECT k, 'test', o + INTERVAL 7 DAY, o + INTERVAL 9 DAY FROM k)
    SELECT event_id, CAST(k AS INTEGER) AS fold, split FROM events JOIN f ON date_trunc('hour', ts) >= a AND date_trunc('hour', ts) < b""",
)
def _(spark, sf):
    e = events(spark, sf).select("event_id", F.date_trunc("HOUR", "ts").alias("cutoff"))
    return X.walk_forward(e, 2, gap=_GAP, evaluation=timedelta(days=2), initial=timedelta(days=6)).select("event_id", "fold", "split")


def _histories(spark, sf):
    """Values of each user in time order, a fifth of them masked."""
    e = events(spark, sf)
    own = F.array_sort(F.collect_list(F.struct("ts", "event_id", "value")))
    g = e.groupBy("user_id").agg(own.alias("x"))
    return g.select("user_id", F.transform("x", lambda t: t["value"]).alias("v"), F.transform("x", lambda t: (t["event_id"] % 5 != 0).cast("int")).alias("m"))


_HIST = "h AS (SELECT user_id, list(value ORDER BY ts, event_id) AS a FROM events WHERE event_id % 5 <> 0 GROUP BY 1), l AS (SELECT user_id, a, a[greatest(1, len(a) - 14):] AS b FROM h)"


@query(
    "ml4_ml5_ml6_baselines",
    f"""WITH {_HIST}, u AS (SELECT user_id, b, unnest(b) AS y, unnest(range(0, len(b))) AS i FROM l), f AS (SELECT user_id, regr_intercept(y, i) + regr_slope(y, i) * count(*) AS ahead, min(y) AS lo, max(y) AS hi, count(*) AS n, median(y) AS med FROM u GROUP BY 1)
    SELECT l.user_id, round(a[len(a)], 4) AS persistence, round(CASE WHEN n < 2 THEN a[len(a)] ELSE least(hi, greatest(lo, ahead)) END + 1e-9, 4) AS drift, round(med + 1e-9, 4) AS med FROM l JOIN f USING (user_id)""",
)
def _(spark, sf):
    h = M.observed_values("v", "m")
    return _histories(spark, sf).where(F.size(F.filter("m", lambda x: x == 1)) > 0).select("user_id", r4(M.persistence(h), "persistence"), r4(M.linear_drift(h) + 1e-9, "drift"), r4(M.rolling_median(h) + 1e-9, "med"))


_KEY = ["row_id"]


@query(
    "agg11_agg13_ml17_reports",
    f"""WITH {SCORED}, k AS (SELECT model, p, t, row_id, row_number() OVER w AS r, sum(t) OVER w AS c FROM scored WHERE k = 1 WINDOW w AS (PARTITION BY model ORDER BY p DESC, row_id)), a AS (SELECT model, sum(c / CAST(r AS DOUBLE) * t) / sum(t) AS ap FROM k GROUP BY 1),
    g AS (SELECT model, avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) ** 2)) AS rmse, avg((p - t) ** 2) FILTER (WHERE k = 1) AS brier, -avg(t * ln(greatest(1e-6, least(1 - 1e-6, p))) + (1 - t) * ln(1 - greatest(1e-6, least(1 - 1e-6, p)))) FILTER (WHERE k = 1) AS ll,
    sum(CASE WHEN k = 1 AND p >= 0.6 AND t = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN k = 1 AND p >= 0.6 AND t = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN k = 1 AND p < 0.6 AND t = 1 THEN 1 ELSE 0 END) AS fn, avg(CASE WHEN actual >= p10 AND actual <= p90 THEN 1.0 ELSE 0.0 END) AS cov FROM scored GROUP BY 1)
    SELECT model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(brier, 4) AS brier, round(ll, 4) AS log_loss, round(tp / (tp + fp), 4) AS prec, round(tp / (tp + fn), 4) AS recall, round(2 * tp / (2 * tp + fp + fn), 4) AS f1, round(cov, 4) AS coverage, round(ap, 4) AS pr_auc FROM g JOIN a USING (model)""",
)
def _(spark, sf):
    r = E.comparison(scored(spark, sf), 0.6, _KEY)
    return r.select("model", *[r4(a, b) for a, b in (("mae", "mae"), ("rmse", "rmse"), ("brier", "brier"), ("log_loss", "log_loss"), ("precision", "prec"), ("recall", "recall"), ("f1", "f1"), ("interval_coverage", "coverage"), ("pr_auc", "pr_auc"))])


_COH = f"""{SCORED}, r AS (SELECT *, ntile(3) OVER (PARTITION BY model ORDER BY volatility, row_id) AS v3 FROM scored),
 c AS (SELECT model, abs(predicted - actual) AS e, unnest(['current_' || coalesce(cs, 'unknown'), CASE WHEN minute(cutoff) % 15 < 5 THEN 'quarter_hour_phase_start' WHEN minute(cutoff) % 15 < 10 THEN 'quarter_hour_phase_middle' ELSE 'quarter_hour_phase_end' END,
 CASE quality_code WHEN 1 THEN 'source_quality_validated' WHEN 0 THEN 'source_quality_unvalidated' ELSE 'source_quality_unknown' END, ['low_volatility', 'medium_volatility', 'high_volatility'][v3]]) AS cohort FROM r)"""


def _cohorts(spark, sf):
    return E.cohort_mae(E.with_cohorts(scored(spark, sf), _KEY, ["model"]), ["model"])


@query("agg12_win16_ml16_cohorts", f"WITH {_COH} SELECT model, cohort, round(avg(e), 4) AS mae, count(*) AS n FROM c GROUP BY 1, 2")
def _(spark, sf):
    return _cohorts(spark, sf).select("model", "cohort", r4("mae", "mae"), F.col("rows").alias("n"))


@query(
    "agg14_f1_threshold",
    f"""WITH {SCORED}, d AS (SELECT p, count(*) AS n, sum(t) AS s FROM scored WHERE k = 1 AND model = 'candidate' GROUP BY 1), w AS (SELECT p, sum(n) OVER o AS called, sum(s) OVER o AS hits, sum(s) OVER () AS total FROM d WINDOW o AS (ORDER BY p DESC))
    SELECT round(p, 4) AS threshold, round(2 * hits / (called + total), 4) AS f1 FROM w ORDER BY 2 * hits / (called + total) DESC, p LIMIT 1""",
)
def _(spark, sf):
    b = R.f1_threshold(scored(spark, sf).where("flip_mask = 1 and model = 'candidate'"), "flip_target", "flip_probability")
    return b.select(r4("threshold", "threshold"), r4("f1", "f1"))


@query("agg15_agg16_weights", f"WITH {SCORED} SELECT model, round(sum(CASE WHEN k = 1 AND t = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN k = 1 AND t = 1 THEN 1 ELSE 0 END), 4) AS positive_weight, round(avg(abs(actual)) + 0.25 * (avg((p - t) ** 2) FILTER (WHERE k = 1)), 4) AS objective FROM scored GROUP BY 1")
def _(spark, sf):
    s = scored(spark, sf).withColumn("nll", F.abs("actual"))
    return E.positive_weight(s, ["model"]).join(E.validation_objective(s, ["model"]), "model").select("model", r4("positive_weight", "positive_weight"), r4("objective", "objective"))


@query("agg16_volatility", f"WITH {_HIST} SELECT user_id, round(list_aggregate(a, 'stddev_pop') + 1e-9, 4) AS volatility FROM h")
def _(spark, sf):
    h = _histories(spark, sf).where(F.size(F.filter("m", lambda x: x == 1)) > 0)
    return h.select("user_id", r4(E.volatility(F.col("v"), F.col("m"), 1) + 1e-9, "volatility"))


@query("win17_cumulative_precision", f"WITH {SCORED} SELECT row_id, round(sum(t) OVER w / CAST(row_number() OVER w AS DOUBLE), 4) AS precision FROM scored WHERE model = 'classical' AND k = 1 WINDOW w AS (ORDER BY p DESC, row_id)")
def _(spark, sf):
    r = R.running(scored(spark, sf).where("model = 'classical' and flip_mask = 1"), -F.col("flip_probability"), _KEY, {"hits": F.col("flip_target").cast("bigint")})
    return r.select("row_id", r4(F.col("hits") / F.col("rank"), "precision"))


@query(
    "ml18_promotion",
    f"""WITH {_COH}, k AS (SELECT model, p, t, row_id, row_number() OVER w AS r, sum(t) OVER w AS cc FROM scored WHERE k = 1 WINDOW w AS (PARTITION BY model ORDER BY p DESC, row_id)), a AS (SELECT model, sum(cc / CAST(r AS DOUBLE) * t) / sum(t) AS ap FROM k GROUP BY 1),
    g AS (SELECT model, avg(abs(predicted - actual)) AS mae, avg((p - t) ** 2) FILTER (WHERE k = 1) AS brier, avg(CASE WHEN actual >= p10 AND actual <= p90 THEN 1.0 ELSE 0.0 END) AS cov FROM scored GROUP BY 1), m AS (SELECT * FROM g JOIN a USING (model)),
    co AS (SELECT cohort, avg(e) FILTER (WHERE model = 'candidate') AS c, avg(e) FILTER (WHERE model = 'persistence') AS p FROM c GROUP BY 1), w AS (SELECT coalesce(string_agg('cohort:' || cohort, ',' ORDER BY cohort), '') AS worse FROM co WHERE p IS NOT NULL AND (c IS NULL OR c > p * 1.05)),
    q AS (SELECT concat_ws(',', CASE WHEN x.mae > y.mae * 0.98 THEN 'mae' END, CASE WHEN x.ap <= z.ap THEN 'pr_auc' END, CASE WHEN x.brier > z.brier - 0.01 THEN 'brier' END, CASE WHEN NOT x.cov BETWEEN 0.75 AND 0.85 THEN 'coverage' END, nullif(worse, '')) AS reasons
    FROM m x, m y, m z, w WHERE x.model = 'candidate' AND y.model = 'persistence' AND z.model = 'classical') SELECT reasons = '' AS promote, reasons FROM q""",
)
def _(spark, sf):
    d = E.promotion_decision(E.comparison(scored(spark, sf), 0.6, _KEY), _cohorts(spark, sf))
    return d.select("promote", F.array_join("reasons", ",").alias("reasons"))


@query(
    "scl11_isotonic_apply",
    "WITH e AS (SELECT event_id, value / 200 AS x FROM events) SELECT event_id, round(CASE WHEN x < 0.1 THEN 0.05 WHEN x < 0.3 THEN 0.05 + 0.35 * (x - 0.1) / 0.2 WHEN x < 0.9 THEN 0.4 + 0.5 * (x - 0.3) / 0.6 ELSE 0.9 END + 1e-9, 4) AS y FROM e",
)
def _(spark, sf):
    e = events(spark, sf).select("event_id", (F.col("value") / 200).alias("raw"))
    return M.calibrated(e, [0.1, 0.3, 0.9], [0.05, 0.4, 0.9]).select("event_id", r4(F.col("calibrated") + 1e-9, "y"))


@query(
    "ml8_isotonic_fit",
    f"""WITH {SCORED}, d AS (SELECT p, count(*) AS n, sum(t) AS s FROM scored WHERE k = 1 AND model = 'candidate' GROUP BY 1), c AS (SELECT p, row_number() OVER w AS i, sum(n) OVER w AS cn, sum(s) OVER w AS cs FROM d WINDOW w AS (ORDER BY p)),
    m AS (SELECT j.i AS j, k.i AS i, k.p, min((k.cs - coalesce(b.cs, 0)) / CAST(k.cn - coalesce(b.cn, 0) AS DOUBLE)) OVER (PARTITION BY j.i ORDER BY k.i DESC) AS least FROM c j LEFT JOIN c b ON b.i = j.i - 1 JOIN c k ON k.i >= j.i),
    y AS (SELECT p, max(least) AS y FROM m GROUP BY p), v AS (SELECT y, sum(n) AS n, sum(s) AS s FROM d JOIN y USING (p) GROUP BY y), w AS (SELECT y, sum(n) OVER o AS called, sum(s) OVER o AS hits, sum(s) OVER () AS total FROM v WINDOW o AS (ORDER BY y DESC)),
    b AS (SELECT y FROM w ORDER BY 2 * hits / (called + total) DESC, y LIMIT 1)
    SELECT row_id, round(y.y, 4) + 0.0 AS calibrated, round(b.y, 4) AS threshold FROM scored JOIN y USING (p), b WHERE k = 1 AND model = 'candidate'""",
)
def _(spark, sf):
    """The plain definition in SQL: the largest over beginnings of the least mean over ends.  Stretches of 256 blocks, so that several merge."""
    s = scored(spark, sf).where("flip_mask = 1 and model = 'candidate'").withColumn("raw", F.col("flip_probability"))
    model, threshold = isotonic_fit(s, stretch=256)
    return calibrate(s, model).select("row_id", r4("calibrated", "calibrated"), F.lit(round(threshold, 4)).alias("threshold"))


@query("ml7_boosted_trees")
def _(spark, sf):
    c = P.canonical_latest(observations(spark, sf))
    x = c.select("series", F.col("timestamp").alias("cutoff"), F.col("system_imbalance_mw").alias("latest"), S.state_name(sign_of(F.col("system_imbalance_mw"), DEADBAND)).alias("current_state"), F.coalesce("ace_mw", F.lit(0.0)).alias("ace"))
    e = L.training_examples(x, c, DEADBAND, ["series"], STEP)
    return M.fit_trees(e, ["latest", "ace"])(e).select("series", ms("cutoff", "t_ms"), r4("tree_value", "value"), r4("tree_flip", "flip"))


def vector_examples(spark, sf):
    """Each vector as eight places of eight channels with masks; its label is the next value, and whether it is odd the flip."""
    e = table(spark, sf, "embeddings")
    return e.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), F.transform("embedding", lambda x: (x > -0.05).cast("int")).alias("m"),
        F.col("label").cast("double").alias("target_next"), (F.col("label") % 2).cast("double").alias("flip_target"), F.lit(1.0).alias("flip_mask"),
    )


@query("ml7_agg10_boosted_trees")
def _(spark, sf):
    e = vector_examples(spark, sf)
    wide, names = L.summary_features(e, "v", "m", 8, ["vec_id"], masked=True)
    x = wide.join(e.select("vec_id", "target_next", "flip_target", "flip_mask"), "vec_id")
    return M.fit_trees(x, names)(x).select("vec_id", "target_next", r4("tree_value", "value"), r4("tree_flip", "flip"))


def members(spark, sf):
    """Three members' outputs for each vector, from slices of it."""
    e = table(spark, sf, "embeddings").withColumn("e", F.transform("embedding", lambda x: x.cast("double")))
    part = lambda k: F.slice("e", 1 + 3 * k, 3)
    one = [F.struct(F.lit(k).alias("member"), part(k).alias("logits"), F.transform(part(k + 1), lambda x: x * 60).alias("means"), F.transform(part(k + 2), lambda x: x * 10).alias("log_scales"), (F.get("e", F.lit(k)) * 4).alias("flip_logit"), F.get("e", F.lit(k)).alias("delta")) for k in range(3)]
    state = F.when(F.col("vec_id") % 3 == 0, "positive").when(F.col("vec_id") % 3 == 1, "negative")
    return e.select(F.col("vec_id").alias("example"), state.alias("current_state"), (F.get("e", F.lit(0)) * 50).alias("actual"), F.explode(F.array(*one)).alias("x")).select("example", "current_state", "actual", "x.*")


@query("ml9_ml11_mixture_scores")
def _(spark, sf):
    s = M.ensemble_scores(members(spark, sf), DEADBAND, actual="actual")
    return s.select("example", *[r4(c, c) for c in ("p10_mw", "system_imbalance_mw", "p90_mw", "flip_probability", "nll", "distribution_flip_probability", "delta_mw")], "will_flip", "predicted_state")


@query("ml9_mixture_order", "SELECT vec_id AS example, round((CAST(embedding[1] AS DOUBLE) + embedding[2] + embedding[3]) / 3 + 1e-9, 4) AS delta, true AS ordered, true AS finite FROM embeddings")
def _(spark, sf):
    """What SQL can say of mixtures: quantiles in order, probabilities in range, finite likelihoods, and the mean of the members' deltas."""
    s = M.ensemble_scores(members(spark, sf), DEADBAND, actual="actual")
    ordered = (F.col("p10_mw") <= F.col("system_imbalance_mw")) & (F.col("system_imbalance_mw") <= F.col("p90_mw")) & F.col("flip_probability").between(0, 1) & F.col("distribution_flip_probability").between(0, 1)
    return s.select("example", r4(F.col("delta_mw") + 1e-9, "delta"), ordered.alias("ordered"), (F.col("nll").isNotNull() & ~F.isnan("nll") & (F.abs("nll") < float("inf"))).alias("finite"))


@query(
    "ml9_mixture_flip_logit",
    """WITH e AS (SELECT vec_id AS example, 1 / (1 + exp(-4 * (CAST(embedding[1] AS DOUBLE) + embedding[2] + embedding[3]) / 3)) AS p, CASE vec_id % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' END AS cs FROM embeddings)
    SELECT example, round(p + 1e-9, 4) AS p, cs IS NOT NULL AND p >= 0.5 AS will_flip FROM e""",
)
def _(spark, sf):
    s = M.ensemble_scores(members(spark, sf), DEADBAND)
    return s.select("example", r4(F.col("flip_probability") + 1e-9, "p"), "will_flip")


@query(
    "ml12_ml13_fallback",
    """WITH e AS (SELECT vec_id AS example, vec_id % 4 <> 0 AS eligible, CASE WHEN vec_id % 7 <> 0 THEN CAST(label AS DOUBLE) * 10 - 20 END AS latest, CASE vec_id % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' END AS cs FROM embeddings)
    SELECT example, CASE WHEN eligible THEN 'model' ELSE 'degraded' END AS prediction_quality, CASE WHEN NOT eligible THEN 'insufficient_feature_history' END AS degraded_reason, NOT eligible AND latest IS NULL AS rejected, CASE WHEN NOT eligible THEN round(latest, 4) + 0.0 END AS fallback,
    CASE WHEN NOT eligible THEN CASE WHEN latest > 10 THEN 'positive' WHEN latest < -10 THEN 'negative' ELSE cs END END AS fallback_state FROM e""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    snaps = e.select(F.col("vec_id").alias("example"), (F.col("vec_id") % 4 != 0).alias("eligible"), F.when(F.col("vec_id") % 7 != 0, F.col("label").cast("double") * 10 - 20).alias("latest"), F.when(F.col("vec_id") % 3 == 0, "positive").when(F.col("vec_id") % 3 == 1, "negative").alias("current_state"))
    f = M.forecasts(snaps, M.ensemble_scores(members(spark, sf), DEADBAND), DEADBAND)
    fell = F.col("prediction_quality") == "degraded"
    return f.select("example", "prediction_quality", "degraded_reason", "rejected", F.when(fell, F.round("system_imbalance_mw", 4) + 0.0).alias("fallback"), F.when(fell, F.col("predicted_state")).alias("fallback_state"))


@query("ml15_reconciled_outcomes", f"WITH {PRED}, {_OUT} SELECT count(*) AS n, sum(CASE WHEN was <> rs THEN 1 ELSE 0 END) AS flips FROM outc")
def _(spark, sf):
    return outcomes(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("flip_actual").cast("bigint")).alias("flips"))
