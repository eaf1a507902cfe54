"""Time-series engine: known values on small tables, equality of forms, and no leakage."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions import identity as I
from tidegrid.functions import scalars as S
from tidegrid.functions.contract import names
from tidegrid.functions.schemas import TABLES, Registry
from tidegrid.operators import evaluate as E
from tidegrid.operators import forecast as M
from tidegrid.operators import grid as G
from tidegrid.operators import isotonic as Y
from tidegrid.operators import labels as L
from tidegrid.operators import pit as P
from tidegrid.operators import ranks as R
from tidegrid.operators import routing as T
from tidegrid.operators import serving as V
from tidegrid.operators import splits as X
from tidegrid.operators import windows as W
from tidegrid.plans import snapshots as N
from tidegrid.plans.exports import export_from_csv, observations_from_csv, requests_for
from tidegrid.sources import records as C
from tidegrid.sources import sinks as K

T0 = datetime(2026, 1, 5, 10, 7)
OBS = "series string, timestamp timestamp, ingested_at timestamp, event_id string, row_version bigint, system_imbalance_mw double, ace_mw double, imbalance_price_eur_mwh double, marginal_incremental_price_eur_mwh double, marginal_decremental_price_eur_mwh double, quality_status string"
SMALL = Registry(local_steps=30, bin_steps=5, bins=6, min_observed=5)


def minutes(values, cutoff=T0, delay=5, version=1):
    """Rows that end at the cutoff, each available some seconds later."""
    n = len(values)
    return [("s", t := cutoff - timedelta(minutes=n - 1 - i), t + timedelta(seconds=delay), f"e{i}-{version}", version, float(v), None, None, None, None, "Validated") for i, v in enumerate(values) if v is not None]


def obs(spark, rows):
    return spark.createDataFrame(rows, OBS)


def request(spark, *pairs):
    return spark.createDataFrame([(f"r{i}", "s", c, k) for i, (c, k) in enumerate(pairs)], "request_id string, series string, cutoff timestamp, knowledge timestamp")


def test_hysteresis_keeps_its_state_on_the_boundary(spark):
    values = [0, 10, 10.1, -10, 5, -10.1, 10, None, 11]
    d = G.dense_grid(obs(spark, minutes(values)), ["series"])
    got = [r["state_sign"] for r in W.states(d, ["series"], "system_imbalance_mw", 10.0).orderBy("timestamp").collect()]
    assert got == [None, None, 1, 1, 1, -1, -1, -1, 1]


def test_long_quiet_stretch_then_flip(spark):
    d = G.dense_grid(obs(spark, minutes([20] * 30 + [0] * 149 + [-15])), ["series"])
    rows = W.states(d, ["series"], "system_imbalance_mw", 10.0).orderBy("timestamp").collect()
    assert rows[30]["state_sign"] == 1 and rows[30]["state_duration"] == 30 and rows[-1]["state_sign"] == -1 and rows[-1]["state_duration"] == 0


def test_two_level_scan_equals_one_window(spark):
    import random

    r = random.Random(4)
    values = [None if r.random() < 0.3 else r.choice([-20, -5, 0, 5, 20]) if r.random() < 0.2 else r.choice([-3, 3]) for _ in range(600)]
    d = G.dense_grid(obs(spark, minutes(values)), ["series"])
    pick = ["timestamp", "state_sign", "state_since", "state_duration", "age"]
    one = W.states(d, ["series"], "system_imbalance_mw", 10.0).select(*pick)
    two = W.two_level_states(d, ["series"], "system_imbalance_mw", 10.0, chunk_seconds=3600).select(*pick)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_rolling_features(spark):
    v = "system_imbalance_mw"
    d = G.dense_grid(obs(spark, minutes([3, 1, 4, 1, 5, None, 9])), ["series"]).withColumn("__i", F.unix_seconds("timestamp") / 60.0)
    r = d.select("timestamp", W.ewm(v, 5, ["series"]).alias("e"), W.rolling_median(v, 5, ["series"]).alias("m"), W.slope(v, 5, ["series"]).alias("s"), W.robust_scale(v, 5, ["series"]).alias("r"), *[c.alias(k) for k, c in W.deltas(v, ["series"]).items()]).orderBy("timestamp").collect()
    a, e = 1 / 3, 3.0
    for x in (1, 4, 1, 5):
        e = a * x + (1 - a) * e
    assert math.isclose(r[4]["e"], e) and r[4]["m"] == 3 and math.isclose(r[4]["s"], 0.4) and math.isclose(r[4]["r"], 1.4826 * 2)
    assert r[3]["e"] is None and r[5]["m"] is None and r[6]["delta_1_mw"] is None and r[4]["delta_1_mw"] == 4 and r[4]["acceleration_mw"] == 7 and r[2]["delta_2_mw"] == 1


def test_canonical_keeps_nulls_of_the_winning_row(spark):
    rows = [("s", T0, T0, "a", 1, 1.0, 5.0, None, None, None, "x"), ("s", T0, T0 + timedelta(seconds=9), "b", 2, 2.0, None, None, None, None, "y")]
    r = P.canonical_latest(obs(spark, rows)).first()
    assert (r["system_imbalance_mw"], r["ace_mw"], r["event_id"]) == (2.0, None, "b")
    assert P.canonical_latest(obs(spark, rows), knowledge=T0).first()["event_id"] == "a"


def test_late_correction_flips_only_what_is_known_later(spark):
    rows = minutes([25] * 40) + minutes([-25], version=2, delay=600)
    asks = request(spark, (T0, T0 + timedelta(seconds=30)), (T0, T0 + timedelta(seconds=900)))
    got = {r["request_id"]: r["current_state"] for r in N.snapshots_pit(obs(spark, rows), asks, SMALL).collect()}
    assert got == {"r0": "positive", "r1": "negative"}


def test_online_and_replay_snapshots_are_equal(spark):
    rows = minutes([(i * 7) % 45 - 20 if i % 11 else None for i in range(120)]) + minutes([-30] * 8, version=2, delay=900) + minutes([15] * 3, cutoff=T0 - timedelta(minutes=9), version=3, delay=40)
    asks = request(spark, *[(T0 - timedelta(minutes=m), T0 - timedelta(minutes=m) + timedelta(seconds=k)) for m in (0, 3, 17) for k in (0, 30, 1000)])
    pick = ["request_id", "local_values", "local_masks", "context_values", "context_masks", "static_values", "current_state", "model_eligible", "latest"]
    a, b = (f(obs(spark, rows), asks, SMALL).select(*pick) for f in (N.snapshots, N.snapshots_pit))
    assert a.count() == 9 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    r = a.first()
    assert len(r["local_values"]) == 30 * len(SMALL.local) and len(r["context_values"]) == 6 * 19 and len(r["static_values"]) == 13


def test_future_and_later_known_rows_change_nothing(spark):
    asks = request(spark, (T0, T0 + timedelta(seconds=5)))
    rows = minutes([12, -14, 13, 2] * 15)
    more = [*rows, *minutes([99] * 20, cutoff=T0 + timedelta(minutes=20), version=5), *minutes([-99] * 10, version=9, delay=3600)]
    a, b = (N.snapshots_pit(obs(spark, x), asks, SMALL).drop("created_at") for x in (rows, more))
    assert a.exceptAll(b).count() == 0


def test_context_bins_are_right_closed(spark):
    reg = Registry(local_steps=180, bins=96, bin_steps=15)
    cutoff = T0
    n = 1447 if (cutoff.minute % 15) == 7 else None
    rows = minutes([-100] * 7 + [100] * (n - 7))
    s = N.snapshots_pit(obs(spark, rows), request(spark, (cutoff, cutoff + timedelta(minutes=1))), reg).first()
    assert math.isclose(s["context_values"][0], (8 * 100 - 7 * 100) / 15, rel_tol=1e-6)
    assert sum(s["context_masks"]) == 96 * 5


def test_seeded_duration(spark):
    reg = Registry(local_steps=180)
    start = T0 - timedelta(minutes=2000)
    rows = [*minutes([20], cutoff=start), *minutes([0] * 1447)]
    s = N.snapshots_pit(obs(spark, rows), request(spark, (T0, T0 + timedelta(minutes=1))), reg).first()
    at = (180 - 1) * len(reg.local) + reg.local.index("state_duration_minutes")
    assert s["current_state"] == "positive" and s["local_values"][at] == 2000


def test_offset_change_and_holidays(spark):
    df = spark.createDataFrame([(datetime(2026, 3, 29, 0, 30),), (datetime(2026, 10, 25, 0, 30),), (datetime(2026, 7, 21, 12),), (datetime(2026, 1, 3, 12),)], "cutoff timestamp")
    c = S.calendar(F.col("cutoff"))
    got = S.with_holiday(df, S.holidays(spark, 2025, 2027)).select("cutoff", c["is_dst_transition"].alias("d"), c["is_weekend"].alias("w"), "is_holiday").orderBy("cutoff").collect()
    assert [(r["d"], r["w"], r["is_holiday"]) for r in got] == [(0, 1, 0), (1, 1, 0), (0, 0, 1), (1, 1, 0)]
    assert [S.easter(y) for y in (2024, 2025, 2026, 2038)] == [date(2024, 3, 31), date(2025, 4, 20), date(2026, 4, 5), date(2038, 4, 25)]


def test_history_start(spark):
    r = spark.createDataFrame([(T0,)], "c timestamp").select(S.history_start(F.col("c")).alias("h")).first()
    assert (T0 - r["h"]).total_seconds() / 60 + 1 == 1447


def test_cutoffs_gaps_and_even_spacing(spark):
    o = obs(spark, minutes([1] * 10 + [None] + [1] * 10))
    cuts = [r["cutoff"] for r in G.select_cutoffs(o, 5, 3).orderBy("cutoff").collect()]
    first = T0 - timedelta(minutes=20)
    assert cuts == [first + timedelta(minutes=m) for m in (6, 15, 18)]
    many = spark.createDataFrame([("s", i) for i in range(10)], "series string, cutoff int")
    pick = lambda n: [r["cutoff"] for r in G.evenly_spaced(many, n).orderBy("cutoff").collect()]
    assert pick(3) == [0, 4, 9] and pick(1) == [9] and pick(10) == list(range(10)) and pick(50) == list(range(10))
    assert G.missing_steps(o, first, T0).first()["timestamp"] == first + timedelta(minutes=10)
    with pytest.raises(ValueError):
        G.require_contiguous(o, first, T0)


def test_labels(spark):
    o = obs(spark, minutes([12, -20, 5, 7]))
    s = o.select("series", F.col("timestamp").alias("cutoff"), F.col("system_imbalance_mw").alias("latest"), F.when(F.col("system_imbalance_mw") > 10, "positive").alias("current_state"))
    r = L.training_examples(s, o, 10.0).orderBy("cutoff").collect()
    assert len(r) == 3 and (r[0]["target_next"], r[0]["target_delta"], r[0]["flip_target"], r[0]["flip_mask"]) == (-20, -32, 1, 1)
    assert r[0]["auxiliary_target"] == [5, 0, 0] and r[0]["auxiliary_mask"] == [1, 0, 0] and r[1]["flip_mask"] == 0


def report_rows(spark):
    return spark.createDataFrame([(0, 0.0, 1.0, -1.0, 1.0, 0, 0.1, 1), (1, 2.0, 3.0, 3.0, 4.0, 1, 0.9, 1), (2, 4.0, 3.0, 3.0, 5.0, 0, 0.2, 1), (3, 6.0, 7.0, 7.0, 8.0, 1, 0.8, 1)], "id int, actual double, predicted double, p10 double, p90 double, flip_target int, flip_probability double, flip_mask int")


def test_evaluation_report(spark):
    r = E.evaluation_report(report_rows(spark), 0.5, ["id"]).first()
    assert (r["mae"], r["interval_coverage"], r["precision"], r["recall"], r["f1"], r["pr_auc"], r["invalid"]) == (1, 0.5, 1, 1, 1, 1, 0)
    wide = report_rows(spark).withColumn("predicted", F.col("predicted") + F.when(F.col("id") == 3, 2000).otherwise(0)).withColumn("flip_mask", (F.col("id") < 2).cast("int"))
    m = E.evaluation_report(wide, 0.5, ["id"]).first()
    assert m["mae"] > 400 and math.isclose(m["brier"], 0.01)
    with pytest.raises(ValueError):
        E.require_valid(E.evaluation_report(report_rows(spark).withColumn("p10", F.lit(99.0)), 0.5, ["id"]))


def test_ranks(spark):
    df = spark.createDataFrame([(i, float(i * 37 % 100), int(i % 3 == 0)) for i in range(1000)], "id int, p double, t int")
    rows = sorted(df.collect(), key=lambda r: (-r["p"], r["id"]))
    hits, ap = 0, 0.0
    for i, r in enumerate(rows, 1):
        hits += r["t"]
        ap += r["t"] * hits / i
    assert math.isclose(R.average_precision(df, "t", "p", ["id"]).first()["pr_auc"], ap / hits)
    five = spark.createDataFrame([(i, v) for i, v in enumerate([3.0, 1.0, 1.0, 2.0, 9.0])], "id int, v double")
    assert {r["id"]: r["tercile"] for r in R.terciles(five, "v", ["id"]).collect()} == {1: 1, 2: 1, 3: 2, 0: 2, 4: 3}
    flips = spark.createDataFrame([(0.2, 0), (0.4, 1), (0.6, 0), (0.8, 1)], "p double, t int")
    assert R.f1_threshold(flips, "t", "p").first()["threshold"] == 0.4


def test_promotion_gives_all_reasons(spark):
    reports = spark.createDataFrame([("candidate", 1.0, 0.4, 0.2, 0.9), ("persistence", 1.0, 0.5, 0.2, 0.8), ("classical", 1.0, 0.5, 0.2, 0.8)], "model string, mae double, pr_auc double, brier double, interval_coverage double")
    cohorts = spark.createDataFrame([("candidate", "a", 2.0), ("persistence", "a", 1.0), ("persistence", "b", 1.0), ("candidate", "c", 1.0), ("persistence", "c", 1.0)], "model string, cohort string, mae double")
    r = E.promotion_decision(reports, cohorts).first()
    assert not r["promote"] and r["reasons"] == ["mae", "pr_auc", "brier", "coverage", "cohort:a", "cohort:b"]
    good = spark.createDataFrame([("candidate", 0.9, 0.6, 0.1, 0.8), ("persistence", 1.0, 0.5, 0.2, 0.8), ("classical", 1.0, 0.5, 0.2, 0.8)], reports.schema)
    assert E.promotion_decision(good, cohorts.limit(0)).first()["promote"]


def test_splits(spark):
    days = spark.createDataFrame([(datetime(2025, 1, 1) + timedelta(hours=h),) for h in range(24 * 40)], "cutoff timestamp")
    kw = {"gap": timedelta(days=1), "evaluation": timedelta(days=3), "initial": timedelta(days=10)}
    s = X.latest_purged_split(days, **kw)
    X.validate_split(s)
    last = {r["split"]: r for r in X.split_sections(s).collect()}
    assert last["test"]["last"] == datetime(2025, 2, 9, 23) and last["test"]["rows"] == 72 and last["train"]["first"] == datetime(2025, 1, 1)
    with pytest.raises(ValueError):
        X.latest_purged_split(days.limit(24 * 12), **kw)
    w = X.walk_forward(days, 2, **kw)
    assert w.select("fold", "split").distinct().count() == 8
    with pytest.raises(ValueError):
        X.walk_forward(days, 9, **kw)


def test_baselines(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([-10.0, 50.0, 0.0],), ([],), ([4.0],), ([float(i) for i in range(30)],)], "h array<double>")
    r = df.select(M.persistence(F.col("h")).alias("p"), M.linear_drift(F.col("h")).alias("d"), M.rolling_median(F.col("h")).alias("m")).collect()
    assert [x["p"] for x in r] == [3, 0, 0, 4, 29] and [x["m"] for x in r] == [2, 0, 0, 4, 22] and r[0]["d"] == 3 and r[4]["d"] == 29 and -10 <= r[1]["d"] <= 50


def test_isotonic(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.2, 0), (0.7, 1), (0.9, 1)], "raw double, flip_target int")
    model, threshold = Y.isotonic_fit(df)
    got = [r["calibrated"] for r in Y.calibrate(df, model).orderBy("raw").collect()]
    assert got == sorted(got) and got[1] == got[2] == 0.5 and threshold == 0.5
    flat, threshold = Y.isotonic_fit(df.where("flip_target = 1"))
    assert [tuple(r)[:3] for r in flat.collect()] == [(0.0, 1.0, 1.0)] and threshold == 0.5
    assert [tuple(r)[:3] for r in Y.isotonic_fit(df.where("false"))[0].collect()] == [(0.0, 1.0, 0.0)]


def test_isotonic_in_stretches_is_the_plain_fit(spark):
    import random

    r = random.Random(9)
    rows = [(p := round(r.random(), 4), int(r.random() < p * p)) for _ in range(6000)] + [(0.5, i % 3 == 0 and 1 or 0) for i in range(3000)]
    blocks: list[list[float]] = []
    for p in sorted({p for p, _ in rows}):
        own = [t for q, t in rows if q == p] if p == 0.5 else None
        blocks.append([p, p, len(own), sum(own)] if own else [p, p, 0, 0])
    index = {b[0]: b for b in blocks}
    for p, t in rows:
        if p != 0.5:
            index[p][2] += 1
            index[p][3] += t
    stack: list[list[float]] = []
    for b in blocks:
        stack.append(list(b))
        while len(stack) > 1 and stack[-2][3] * stack[-1][2] >= stack[-1][3] * stack[-2][2]:
            last = stack.pop()
            stack[-1] = [stack[-1][0], last[1], stack[-1][2] + last[2], stack[-1][3] + last[3]]
    df = spark.createDataFrame(rows, "raw double, flip_target int")
    model, _ = Y.isotonic_fit(df, stretch=100)
    assert sorted((x["lo"], x["hi"], round(x["y"], 9)) for x in model.collect()) == [(b[0], b[1], round(b[3] / b[2], 9)) for b in stack]
    asks = spark.createDataFrame([(x,) for x in (-0.5, 0.0, 0.5, 1.0, 2.0, None, *[i / 997 for i in range(997)])], "raw double")
    xs, ys = [x for b in stack for x in (b[0], b[1])], [b[3] / b[2] for b in stack for _ in (0, 1)]
    for x in Y.calibrate(asks, model).collect():
        assert (x["raw"] is None and x["calibrated"] is None) or abs(x["calibrated"] - np.interp(x["raw"], xs, ys)) < 1e-9


def test_mixture_scores(spark):
    rows = [(1, 0, [0.0, 0.0], [-5.0, 5.0], [1.0, 1.0], 0.0, 1.0, "positive"), (1, 1, [0.0, 0.0], [-5.0, 5.0], [1.0, 1.0], 2.0, 3.0, "positive"), (2, 0, [0.0], [7.0], [2.0], -9.0, 0.0, None)]
    df = spark.createDataFrame(rows, "example int, member int, logits array<double>, means array<double>, log_scales array<double>, flip_logit double, delta double, current_state string").withColumn("y", F.lit(7.0))
    r = {x["example"]: x for x in M.ensemble_scores(df, 10.0, actual="y").collect()}
    assert abs(r[1]["system_imbalance_mw"]) < 1e-6 and r[1]["delta_mw"] == 2 and math.isclose(r[1]["flip_probability"], 1 / (1 + math.exp(-1)))
    assert r[1]["will_flip"] and r[1]["predicted_state"] == "negative" and 0 < r[1]["distribution_flip_probability"] < 0.5
    s = math.log1p(math.exp(2)) + 1e-4
    assert math.isclose(r[2]["p90_mw"], 7 + 1.2815515655446004 * s, rel_tol=1e-9) and math.isclose(r[2]["nll"], math.log(s) + 0.5 * math.log(2 * math.pi), rel_tol=1e-9) and r[2]["predicted_state"] is None
    z = M._normal_cdf(__import__("numpy").array([-8.0, -3.0, -1.0, 0.0, 0.5, 2.9, 3.1, 6.0]))
    assert all(math.isclose(a, 0.5 * math.erfc(-b / math.sqrt(2)), rel_tol=1e-11) for a, b in zip(z, [-8.0, -3.0, -1.0, 0.0, 0.5, 2.9, 3.1, 6.0], strict=True))


def test_record_pages_as_lines_of_few_files(spark, tmp_path):
    import json

    record = lambda i: {"datetime": f"2026-01-01T00:{i:02d}:00+00:00", "resolutioncode": "PT15M", "measured": f"{i}"}
    pages = [{"total_count": 30, "results": [record(10 * k + i) for i in range(10)]} for k in range(3)]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)))
    r = C.normalize_load(C.read_record_pages(spark, f"file:{tmp_path}/p.json", C.LOAD_FIELDS, lines=True)).collect()
    assert sorted(x["measured_mw"] for x in r) == list(range(30)) and not any(x["reason"] for x in r)
    (tmp_path / "q.json").write_text("\n".join(map(json.dumps, [*pages, {"total_count": -1, "results": []}])))
    with pytest.raises(ValueError):
        C.read_record_pages(spark, f"file:{tmp_path}/q.json", C.LOAD_FIELDS, lines=True)
    from tidegrid.plans.queries_io import _pages

    many = spark.range(5000).select(F.col("id").alias("k"), *[F.col("id").cast("string").alias(f) for f in C.LOAD_FIELDS])
    got = _pages(many, C.LOAD_FIELDS, spark, "pages")
    assert got.count() == 5000 and len(got.inputFiles()) <= 8  # fifty pages


def test_tails_of_mixtures_are_probabilities(spark):
    draw = __import__("random").Random(3)
    rows = [(i, k, [draw.uniform(-3, 3) for _ in range(3)], [side * draw.uniform(200, 300) for _ in range(3)], [0.0] * 3, 0.0, 0.0, state) for i in range(200) for k in range(3) for side, state in ([(-1, "negative"), (1, "positive")][i % 2],)]
    df = spark.createDataFrame(rows, "example int, member int, logits array<double>, means array<double>, log_scales array<double>, flip_logit double, delta double, current_state string")
    p = [x["distribution_flip_probability"] for x in M.ensemble_scores(df, 10.0).collect()]
    assert len(p) == 200 and all(0 <= x < 1e-300 for x in p)  # far on the side of the state: tiny, and never below 0
    far = df.withColumn("current_state", F.when(F.col("current_state") == "negative", "positive").otherwise("negative"))
    assert all(1 - 1e-12 < x["distribution_flip_probability"] <= 1 for x in M.ensemble_scores(far, 10.0).collect())


def test_fallback_forecasts(spark):
    snaps = spark.createDataFrame([(1, True, 5.0, "positive"), (2, False, -30.0, "positive"), (3, False, None, None), (4, True, 1.0, None)], "example int, eligible boolean, latest double, current_state string")
    score = spark.createDataFrame([(1, 3.0, 1.0, 5.0, 0.2, False, "positive", "positive", 0.1), (4, 3.0, 9.0, 5.0, 0.2, False, None, None, 0.1)], "example int, system_imbalance_mw double, p10_mw double, p90_mw double, flip_probability double, will_flip boolean, current_state string, predicted_state string, delta_mw double")
    r = {x["example"]: x for x in M.forecasts(snaps, score, 10.0).collect()}
    assert [r[i]["degraded_reason"] for i in (1, 2, 3, 4)] == [None, "insufficient_feature_history", "insufficient_feature_history", "model_inference_failed"]
    assert r[2]["p10_mw"] == r[2]["p90_mw"] == -30 and r[2]["predicted_state"] == "negative" and r[3]["rejected"] and not r[2]["rejected"]


PORTAL = "Datetime;Resolution code;Quarter hour;Quality status;ACE;System imbalance;Alpha;Alpha';Marginal incremental price;Marginal decremental price;Imbalance Price"


def write(path, lines):
    path.write_text("﻿" + "\n".join([PORTAL, *lines]) + "\n", encoding="utf-8")
    return f"file:{path}"


def csv_rows(n, start=datetime(2026, 1, 1)):
    return [f"{(start + timedelta(minutes=i)).isoformat()}+00:00;PT1M;{start.isoformat()}+00:00;Validated;;{(i * 13) % 60 - 30};;;;;5" for i in range(n)][::-1]


def test_portal_csv(spark, tmp_path):
    ok = C.read_minute_csv(spark, write(tmp_path / "a.csv", ["2026-01-01T02:00:00+02:00;PT1M;2026-01-01T02:00:00+02:00;Validated; ;-7.5;1;;;;", *csv_rows(3, datetime(2026, 1, 1, 5))]))
    r = ok.collect()
    assert r[0]["timestamp"] == datetime(2026, 1, 1) and r[0]["ace_mw"] is None and r[0]["system_imbalance_mw"] == -7.5 and [x["timestamp"] for x in r] == sorted(x["timestamp"] for x in r)
    for name, lines in (("twice", csv_rows(2) + csv_rows(1)), ("none", []), ("bad", [csv_rows(1)[0].replace("PT1M", "PT5M")]), ("text", [csv_rows(1)[0].replace(";-30;", ";x;")])):
        with pytest.raises(ValueError):
            C.read_minute_csv(spark, write(tmp_path / f"{name}.csv", lines))
    (tmp_path / "short.csv").write_text("Datetime;ACE\n1;2\n")
    with pytest.raises(ValueError):
        C.read_minute_csv(spark, f"file:{tmp_path}/short.csv")


def test_export_and_manifest(spark, tmp_path):
    csv, out = write(tmp_path / "b.csv", csv_rows(120)), f"file:{tmp_path}/dataset"
    reg = Registry(local_steps=20, bin_steps=5, bins=4, min_observed=5)
    meta = export_from_csv(spark, csv, out, reg, stride=10)
    assert meta["examples"] == sum(s["rows"] for s in meta["shards"]) > 5 and meta["feature_schema_hash"] == reg.fingerprint()
    with pytest.raises(FileExistsError):
        export_from_csv(spark, csv, out, reg, stride=10)
    assert K.verify_dataset(spark, out)["digest"] == meta["digest"]
    assert export_from_csv(spark, csv, out, reg, stride=10, max_examples=3, force=True)["examples"] == 3
    shard = next(p for p in (tmp_path / "dataset").glob("*.parquet"))
    shard.write_bytes(next(p for p in (tmp_path / "dataset").glob("*.parquet") if p != shard).read_bytes() if len(list((tmp_path / "dataset").glob("*.parquet"))) > 1 else b"x" + shard.read_bytes())
    with pytest.raises(Exception):  # noqa: B017  a changed shard may not even be Parquet
        K.verify_dataset(spark, out)
    assert requests_for(spark.createDataFrame([("s", T0)], "series string, cutoff timestamp")).count() == 1
    assert observations_from_csv(spark, csv).count() == 120


def test_record_pages_and_weather(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"total_count": 2, "results": [{"datetime": "2026-01-01T01:00:00+01:00", "resolutioncode": "PT15M", "measured": 5.5, "dayaheadforecast": null}, {"datetime": "2026-01-01T00:15:00+00:00", "resolutioncode": "PT1H"}]}')
    r = C.normalize_load(C.read_record_pages(spark, f"file:{tmp_path}/p.json", C.LOAD_FIELDS)).orderBy("timestamp").collect()
    assert (r[0]["timestamp"], r[0]["measured_mw"], r[0]["reason"], r[1]["reason"]) == (datetime(2026, 1, 1), 5.5, None, "resolution")
    (tmp_path / "q.json").write_text('{"total_count": -1, "results": []}')
    with pytest.raises(ValueError):
        C.read_record_pages(spark, f"file:{tmp_path}/q.json", C.LOAD_FIELDS)
    names = ("wind_speed_100m", "wind_direction_100m")
    rows = [("a", 0, (["2026-01-01T00:00", "2026-01-01T01:00"], [1.0, None], [350.0, 0.0])), ("b", 0, (["2026-01-01T00:00", "2026-01-01T01:00"], [3.0, None], [10.0, 180.0]))]
    df = spark.createDataFrame(rows, C.weather_schema(names))
    got = {(x["valid_time"].hour, x["variable"]): x for x in C.aggregate_weather(C.explode_weather(df, names)).collect()}
    assert got[0, names[0]]["mean"] == 2 and min(got[0, names[1]]["mean"], 360 - got[0, names[1]]["mean"]) < 1e-9 and got[1, names[1]]["mean"] is None and got[1, names[0]]["mean"] is None
    assert got[1, names[0]]["point_mask"] == {"a": False, "b": False} and got[0, names[1]]["minimum"] is None
    with pytest.raises(ValueError):
        C.explode_weather(spark.createDataFrame([("a", 3600, rows[0][2])], C.weather_schema(names)), names)


def test_identity_and_versions(spark):
    import hashlib

    r = spark.createDataFrame([("ñ", T0)], "k string, t timestamp").select(I.event_id(F.lit("a"), F.lit("b"), F.col("k"), F.lit("1")).alias("i"), I.row_version("t", "k").alias("v")).first()
    assert r["i"] == hashlib.sha256('["a","b","ñ","1"]'.encode()).hexdigest()
    assert r["v"] == int(T0.timestamp() * 1000) * 2**20 + int(hashlib.sha256("ñ".encode()).hexdigest()[:5], 16)


def test_paging(spark):
    rows = [(f"p{i}", T0 + timedelta(minutes=i // 2), T0, 1.0 * i, 1, "positive") for i in range(7)]
    p = spark.createDataFrame(rows, "event_id string, target_time timestamp, generated_at timestamp, system_imbalance_mw double, row_version bigint, predicted_state string")
    seen, cursor = [], None
    while True:
        page, cursor = V.page_and_cursor(V.prediction_page(p, T0, T0 + timedelta(hours=1), 3, cursor), 3)
        seen += [r["event_id"] for r in page]
        if cursor is None:
            break
    assert seen == [f"p{i}" for i in range(7)]
    for bad in ({"limit": 0}, {"cursor": (T0, None)}):
        with pytest.raises(ValueError):
            V.prediction_page(p, T0, T0, **bad)
    assert V.bounded_sample(p, 3).count() == 3


def test_retention_and_typed_tables(spark, tmp_path):
    rows = obs(spark, minutes([1, 2, 3])).withColumn("quarter_hour", F.col("timestamp")).withColumn("resolution_code", F.lit("PT1M"))
    root = f"file:{tmp_path}/t"
    K.write_typed(rows, "imbalance_observations", root)
    K.write_typed(rows, "imbalance_observations", root)
    t = K.read_typed(spark, "imbalance_observations", root)
    assert t.count() == 6 and K.compact(t, "imbalance_observations").count() == 3 and "month" in t.columns
    assert P.time_range(t, T0, T0 + timedelta(days=1)).count() == 2
    assert K.compact_table(spark, "imbalance_observations", root) == ["2026-01"] and K.read_typed(spark, "imbalance_observations", root).count() == 3
    assert K.compact_table(spark, "imbalance_observations", root) == []
    assert set(TABLES) >= {"raw_events", "predictions", "model_versions"}


def test_contract_fingerprint():
    reg = Registry()
    assert reg.fingerprint() == "e266c181b83162ec6988f91f8c951c54f0049e4b1cfe69850bde57b434f1f82b"
    assert reg.local == names("local") and len(reg.static) == 13
    assert Registry(deadband=11.0).fingerprint() != reg.fingerprint() != Registry(step_seconds=900).fingerprint()


def test_snapshot_rules(spark):
    r = spark.createDataFrame([(40, "positive", 5.0), (40, None, 1.0), (29, "positive", 0.0), (40, "negative", 6.0), (40, "negative", None)], "n int, s string, a double").select(T.eligible_snapshot(F.col("n"), F.col("s"), F.col("a")).alias("e")).collect()
    assert [x["e"] for x in r] == [True, False, False, False, False]


def test_preprocessing_knows_its_schema_and_trains_on_train_rows(spark):
    rows = [(1, "train", "h", [1.0, 10.0, 3.0, 0.0], [1, 1, 1, 0]), (2, "train", "h", [5.0, 20.0, 7.0, 40.0], [1, 1, 1, 1]), (3, "test", "h", [1000.0, 0.0, 0.0, 0.0], [1, 0, 0, 0])]
    df = spark.createDataFrame(rows, "example int, split string, feature_schema_hash string, v array<double>, m array<int>")
    fitted = L.fit_preprocessing(df, "v", "m", 2)
    stats = {r["channel"]: r for r in fitted[1].collect()}
    assert fitted[0] == "h" and stats[0]["location"] == 4.0 and stats[0]["scale"] == 3.0 and stats[1]["location"] == 20.0 and stats[1]["scale"] == 15.0
    got = {(r["example"], r["channel"], r["place"]): r["scaled"] for r in L.apply_preprocessing(df, fitted, "v", "m", 2, ["example"]).collect()}
    assert got[1, 0, 0] == -1.0 and got[2, 1, 0] == 0.0 and got[1, 1, 1] == 0.0
    with pytest.raises(ValueError):
        L.fit_preprocessing(df.where("split = 'test'"), "v", "m", 2)
    with pytest.raises(ValueError):
        L.apply_preprocessing(df.withColumn("feature_schema_hash", F.lit("other")), fitted, "v", "m", 2, ["example"])


def test_channel_summaries_volatility_and_source_quality(spark):
    df = spark.createDataFrame([(1, [1.0, 1.0, 4.0, 0.0], [1, 1, 1, 0]), (2, [9.0, 0.0, 9.0, 0.3], [0, 0, 0, 1])], "example int, v array<double>, m array<int>")
    wide, names_ = L.summary_features(df, "v", "m", 2, ["example"])
    r = {x["example"]: x for x in wide.collect()}
    assert len(names_) == 10 and [r[1][f"x0_{p}"] for p in ("last", "mean", "std", "change", "coverage")] == [4.0, 2.5, 1.5, 3.0, 1.0] and r[2]["x0_coverage"] == 0.0 and r[2]["x0_mean"] == 0.0
    got = {x["example"]: x for x in df.select("example", E.volatility(F.col("v"), F.col("m"), 2).alias("s"), E.source_quality(F.col("v"), F.col("m"), 2, 1).alias("q"), E.source_quality(F.col("v"), F.col("m"), 2).alias("none")).collect()}
    assert (got[1]["s"], got[2]["s"]) == (1.5, 0.0) and (got[1]["q"], got[2]["q"]) == (-1, 0) and got[1]["none"] == -1


def test_late_predictions_meet_the_latest_revision(spark):
    at = lambda i: T0 + timedelta(minutes=i)
    seen = spark.createDataFrame([("s", at(1), at(2), "a", 5.0, 1), ("s", at(1), at(9), "b", -20.0, 2)], "series string, timestamp timestamp, ingested_at timestamp, event_id string, system_imbalance_mw double, row_version long")
    p = spark.createDataFrame([("p", "s", at(1), at(1), "positive"), ("late", "s", at(1), at(5), "positive")], "event_id string, series string, target_time timestamp, generated_at timestamp, current_state string")
    early = {r["prediction_event_id"]: r["realized_event_id"] for r in M.reconcile(p, seen, at(4), 10.0).collect()}
    assert early == {"p": "a"}
    late = {r["prediction_event_id"]: (r["realized_event_id"], r["realized_state"], r["flip_actual"]) for r in M.reconcile(p, seen, at(10), 10.0).collect()}
    assert late == {"p": ("b", "negative", True), "late": ("b", "negative", True)}
