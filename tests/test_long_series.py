"""Long series: scans by blocks, features in chunks, versioned day summaries, late rows in streams; each against a plain form."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from tidegrid.functions.schemas import Registry
from tidegrid.operators import grid as G
from tidegrid.operators import pit as P
from tidegrid.operators import scan as Q
from tidegrid.operators import windows as W
from tidegrid.plans import snapshots as N
from tidegrid.plans.exports import export_from_csv
from tidegrid.sources import records as C
from tidegrid.streaming import jobs as J
from tidegrid.streaming.incremental import snapshot_batch

T0 = datetime(2026, 1, 5)
V = "system_imbalance_mw"
OBS = "series string, timestamp timestamp, system_imbalance_mw double, ace_mw double, imbalance_price_eur_mwh double, marginal_incremental_price_eur_mwh double, marginal_decremental_price_eur_mwh double, quality_status string, ingested_at timestamp, event_id string, row_version bigint"
REG = Registry(local_steps=20, bin_steps=5, bins=4, min_observed=3, max_age=5)


def row(series, minute, value, delay=5, version=1, name=""):
    t = T0 + timedelta(minutes=minute)
    return (series, t, value, None, value, None, 1.0, "Validated", t + timedelta(seconds=delay), f"{series}{minute}{name}-{version}", version)


def test_seeds_of_many_chunks(spark):
    r = random.Random(2)
    numbers = {s: sorted(r.sample(range(-3000, 9000), 900)) for s in "ab"}
    rows = [(s, n, n if n % 3 else None) for s, own in numbers.items() for n in own]
    got = {(x["s"], x["n"]): x["seed"] for x in Q.before_each(spark.createDataFrame(rows, "s string, n bigint, e bigint"), ["s"], "n", "e", Q.latest).collect()}
    for s, own in numbers.items():
        last = None
        for n in own:
            assert got[s, n] == last, (s, n)
            last = n if n % 3 else last
    none = spark.createDataFrame([], "s string, n bigint, e bigint")
    assert Q.before_each(none, ["s"], "n", "e", Q.latest).count() == 0


def test_last_as_of_over_buckets(spark):
    r = random.Random(3)
    seen = sorted(r.sample(range(200_000), 60))
    ends = sorted(r.sample(range(-5000, 220_000), 300))
    obs = spark.createDataFrame([("s", T0 + timedelta(minutes=m)) for m in seen], "series string, timestamp timestamp")
    asks = spark.createDataFrame([("s", T0 + timedelta(minutes=m)) for m in ends] + [("t", T0)], "series string, bin_end timestamp")
    got = {(x["series"], x["bin_end"]): x["last"] for x in G.last_as_of(obs, asks, bucket_seconds=3600 * 7).collect()}
    assert len(got) == 301 and got["t", T0] is None
    for m in ends:
        before = [x for x in seen if x <= m]
        assert got["s", T0 + timedelta(minutes=m)] == (T0 + timedelta(minutes=before[-1]) if before else None)


def test_features_in_chunks_are_those_of_one_window(spark):
    r = random.Random(4)
    values = {m: r.choice([-30.0, -5.0, 0.0, 4.0, 25.0, 60.0]) + m % 7 for m in range(700) if r.random() > 0.08 and not 300 < m < 420}
    obs = spark.createDataFrame([row("s", m, v) for m, v in values.items()] + [row("t", 3, 1.0)], OBS)
    reg = Registry()
    chunked = N.minute_features(obs, None, reg, chunk_steps=97)
    known = P.canonical_latest(obs.select("series", "timestamp", *P.RANK, *N.RAW), ["series", "timestamp"]).select("series", "timestamp", *N.RAW)
    whole = W.local_features(G.dense_grid(known, ["series"]), ["series"], reg)
    columns = ["series", "timestamp", "state_since", *reg.local]
    flat = lambda df: {(x["series"], x["timestamp"]): tuple(round(v, 7) if isinstance(v, float) else v for v in x) for x in df.select(*columns).collect()}
    a, b = flat(chunked), flat(whole)
    assert len(a) == 701 and a == b
    specs = chunked._jdf.queryExecution().optimizedPlan().toString().split("windowspecdefinition(series")[1:]
    assert specs and all("chunk" in x[:30] for x in specs)  # no window over a series


def test_seeds_with_corrections_at_any_time(spark):
    r = random.Random(6)
    rows = []
    for m in range(0, 40 * 1440, 187):
        rows.append(row("s", m, r.choice([-40.0, -3.0, 2.0, 40.0]), delay=r.choice([5, 90, 9000, -100_000])))
        if r.random() < 0.3:
            rows.append(row("s", m, r.choice([-40.0, 40.0, 0.0]), delay=r.randrange(100, 60 * 86400), version=2))
    rows += [row("s", 187, 33.0, delay=50 * 86400, version=9), row("t", 10, 5.0)]
    asks = [(f"q{i}", "s", T0 + timedelta(minutes=r.randrange(-100, 42 * 1440)), T0 + timedelta(minutes=r.randrange(-100, 60 * 1440))) for i in range(60)]
    asks += [("late", "s", T0 + timedelta(days=39), T0 + timedelta(days=80)), ("none", "u", T0, T0), ("flat", "t", T0 + timedelta(days=9), T0 + timedelta(days=9))]
    got = {x["request_id"]: (x["sign"], x["state_since"], x["last_observed_at"]) for x in P.state_seed(spark.createDataFrame(asks, "request_id string, series string, before timestamp, knowledge timestamp"), spark.createDataFrame(rows, OBS), 10.0).collect()}
    for name, series, before, knowledge in asks:
        best: dict = {}
        for x in rows:
            if x[0] == series and x[1] <= before and x[8] <= knowledge and (x[1] not in best or (x[10], x[8], x[9]) > best[x[1]][0]):
                best[x[1]] = ((x[10], x[8], x[9]), x[2])
        sign = since = last = None
        for t in sorted(best):
            v, last = best[t][1], t
            own = 1 if v > 10 else -1 if v < -10 else sign
            sign, since = (own, t) if own != sign else (sign, since)
        assert got[name] == (sign, since, last), name


def test_days_with_many_late_changes(spark):
    draw = random.Random(11)
    rows = [row("s", m, draw.uniform(-40, 40)) for m in range(300)]
    rows += [row("s", draw.randrange(300), draw.uniform(-40, 40), delay=86_400 * draw.randrange(1, 30) + i, version=2 + i, name="late") for i in range(400)]
    rows += [row("s", m, draw.uniform(-40, 40), delay=-90_000, version=1, name="early") for m in range(0, 300, 50)]
    iv = P.validity_intervals(spark.createDataFrame(rows, OBS))
    days = P.day_level(iv, 10.0)
    assert "collect_list" not in days._jdf.queryExecution().optimizedPlan().toString()  # no list of a day's changes for each of them
    got = {(x["block"], x["seen"]): x["stretch"] for x in days.collect()}
    day = (T0 - datetime(1970, 1, 1)).days
    start, end = T0, T0 + timedelta(days=1)
    held = [(x["timestamp"], x["system_imbalance_mw"], x["valid_from"], x["valid_to"]) for x in iv.collect()]
    assert set(got) == {(day, end if start < f < end else f) for _, _, f, _ in held} and len(got) > 300
    for (_, seen), x in got.items():
        first = first_at = sign = since = last = None
        for t, v in sorted((t, v) for t, v, a, b in held if a <= seen and (b is None or b > seen)):
            own, last = 1 if v > 10 else -1 if v < -10 else None, t
            if own is not None:
                first, first_at = (own, t) if first is None else (first, first_at)
                sign, since = (own, t) if own != sign else (sign, since)
        assert tuple(x) == (first, first_at, sign, since, last), seen


def put(spark, path, i, rows, kind):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{path}/batch-{i}")


def test_late_rows_are_stepped_in_order_and_those_behind_are_marked(spark, tmp_path):
    kind = "series string, timestamp timestamp, system_imbalance_mw double, row_version bigint"
    at = lambda m: T0 + timedelta(minutes=m)
    batches = [[(10, 50.0, 1)], [(5, -50.0, 1), (10, 60.0, 2), (10, -99.0, 1)], [(11, 0.0, 1), (60, -30.0, 1)], [(61, 5.0, 1)], [(3, -30.0, 1), (90, 5.0, 1)]]
    import time

    for i, rows in enumerate(batches):
        put(spark, f"file:{tmp_path}/in", i, [("a", at(m), v, n) for m, v, n in rows], kind)
        time.sleep(0.05)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"file:{tmp_path}/in/*")
    out = J.drain(J.stateful_states(stream, 10.0, "20 minutes", "row_version"), f"file:{tmp_path}/checkpoint", f"file:{tmp_path}/out").collect()
    got = sorted((x["timestamp"], x["late"], x["system_imbalance_mw"], x["state_sign"], x["state_since"]) for x in out)
    assert got == [(at(3), True, -30.0, None, None), (at(5), False, -50.0, -1, at(5)), (at(10), False, 60.0, 1, at(10)), (at(11), False, 0.0, 1, at(10)), (at(60), False, -30.0, -1, at(60)), (at(61), False, 5.0, -1, at(60))]


def test_state_is_asked_once_for_a_step_of_a_batch():
    import pandas as pd

    class Held(dict):
        asked = 0

        def containsKey(self, key):
            self.asked += 1
            return key in self

        def getValue(self, key):
            self.asked += 1
            return self[key]

        def updateValue(self, key, value):
            self.asked += 1
            self[key] = value

    class Value:
        def __init__(self):
            self.now = (1, 0, 599_999_999)

        exists, get = lambda self: True, lambda self: self.now

    class Handle:
        def __init__(self):
            self.map, self.timers = Held(), []

        getMapState, getValueState = lambda self, *a: self.map, lambda self, *a: Value()

        def registerTimer(self, at):
            self.timers.append(at)

    states, handle = J.OrderedStates(10.0), Handle()
    states.init(handle)
    draw = random.Random(5)
    rows = [(draw.randrange(20), draw.uniform(-40, 40), n) for n in draw.sample(range(5000), 3000)]
    frame = lambda xs: pd.DataFrame({"timestamp": pd.to_datetime([m * 60_000_000 for m, _, _ in xs], unit="us"), "system_imbalance_mw": [v for _, v, _ in xs], "rank": [n for _, _, n in xs]})
    late = pd.concat(list(states.handleInputRows(("s",), iter([frame(rows[k : k + 700]) for k in range(0, 3000, 700)]), None)))
    assert sorted(late["system_imbalance_mw"]) == sorted(v for m, v, _ in rows if m < 10) and late["late"].all()
    assert handle.map == {(m * 60_000_000,): (m * 60_000_000, v, n) for m, v, n in sorted(rows, key=lambda x: x[2]) if m >= 10}
    assert sorted(handle.timers) == [m * 60_000 for m in range(10, 20)] and handle.map.asked <= 20
    assert not list(states.handleInputRows(("s",), iter([frame([(12, 1.0, -1), (13, 2.0, 9000)])]), None))
    assert handle.map[(780_000_000,)] == (780_000_000, 2.0, 9000) and handle.map[(720_000_000,)][2] > 0


def test_batches_add_snapshots_and_change_none(spark, tmp_path):
    rows = [row("s", m, 20.0 if m < 30 else -20.0) for m in range(60)]
    late = [row("s", 50, 5.0, delay=7200, version=2)]
    run, root = snapshot_batch(f"file:{tmp_path}", REG, every=5), f"file:{tmp_path}"
    read = lambda b: {(x["cutoff"], x["knowledge"]): (x["latest"], x["observed"], tuple(x["local_values"]), tuple(x["context_values"])) for x in spark.read.parquet(f"{root}/snapshots/batch={b}").collect()}
    run(spark.createDataFrame(rows, OBS), 0)
    first = read(0)
    run(spark.createDataFrame(late, OBS), 1)
    assert read(0) == first and len(first) == 12
    second = read(1)
    assert {c for c, _ in second} == {T0 + timedelta(minutes=m) for m in (50, 55)} and second[T0 + timedelta(minutes=50), late[0][8]][0] == 5.0
    run(spark.createDataFrame(rows, OBS), 0)  # the first batch once more, after the second: as it was
    assert read(0) == first
    asks = spark.createDataFrame([(f"{c}|{k}", "s", c, k) for c, k in second], "request_id string, series string, cutoff timestamp, knowledge timestamp")
    whole = {(x["cutoff"], x["knowledge"]): (x["latest"], x["observed"], tuple(x["local_values"]), tuple(x["context_values"])) for x in N.snapshots_pit(spark.createDataFrame(rows + late, OBS), asks, REG).collect()}
    assert whole == second


def _revised(seed):
    """Some steps of four days with up to thirty revisions each, known before, inside and after their day, in no order of rank."""
    r = random.Random(seed)
    minutes = sorted({*r.sample(range(4 * 1440), 60), *range(2900, 2960)})
    return [row("s", m, r.uniform(-40, 40), delay=r.choice((r.randrange(-2 * 86400, 0), r.randrange(3600), r.randrange(3600), r.randrange(3 * 86400))), version=v) for m in minutes for v in r.sample(range(100), r.randrange(1, 30))]


def test_revisions_that_no_request_finds_are_left_out(spark):
    rows = _revised(11)
    obs = spark.createDataFrame(rows, OBS)
    r, at = random.Random(12), lambda m: T0 + timedelta(minutes=m)
    asks = [(str(i), "s", at(c), at(c + r.choice((-2000, -30, 1, 2, 700, 4000)))) for i, c in enumerate([*r.sample(range(2900, 2960), 20), *r.sample(range(4 * 1440), 20)])]
    requests = spark.createDataFrame(asks, "request_id string, series string, cutoff timestamp, knowledge timestamp")
    pick = ["request_id", "local_values", "local_masks", "context_values", "context_masks", "current_state", "age", "latest", "observed"]
    online, replay = (sorted(map(tuple, f(obs, requests, REG).select(*pick).collect())) for f in (N.snapshots, N.snapshots_pit))
    assert online == replay and len(online) == 40
    # each step at each of the times, whatever else there is of it
    times = sorted({k for *_, k in asks})
    steps = obs.select("series", "timestamp").distinct()
    wanted = steps.crossJoin(spark.createDataFrame([(k,) for k in times], "knowledge timestamp"))
    reads = wanted.select("series", "knowledge", F.floor(F.unix_seconds("timestamp") / 86400).alias("day"))
    few, every = (P.validity_intervals(x) for x in (P.revisions_read(obs, reads), obs))
    found = [sorted(map(tuple, P.pit_join(wanted, x).select("timestamp", "knowledge", "event_id", "valid_from", V).collect()), key=str) for x in (few, every)]
    assert found[0] == found[1]
    one = P.revisions_read(obs, reads.where(F.col("knowledge") == times[len(times) // 2]))
    assert one.count() == obs.where(F.col("ingested_at") <= F.lit(times[len(times) // 2])).select("timestamp").distinct().count() < len(rows) / 5
    days = [sorted(map(str, P.day_level(P.validity_intervals(x), 10.0).collect())) for x in (P.day_revisions(obs), obs)]
    assert days[0] == days[1] and P.day_revisions(obs).count() < 0.7 * len(rows)


def test_a_batch_of_many_revisions_is_reduced_and_written_by_many_tasks(spark, tmp_path):
    shared, size = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, was = set(shared.glob("intervals-*")), spark.conf.get(size)
    spark.conf.set(size, "4k")
    try:
        rows = [row("s", m, (m * v) % 80 - 40.0, delay=v, version=v) for m in range(60) for v in range(1, 51)]
        snapshot_batch(f"file:{tmp_path}", REG, every=5)(spark.createDataFrame(rows, OBS).repartition(4), 0)
    finally:
        spark.conf.set(size, was)
    assert len(list(tmp_path.glob("history/batch=0/month=2026-01/part-*"))) > 1
    made = spark.read.parquet(f"file:{tmp_path}/snapshots/batch=0")
    (intervals,) = set(shared.glob("intervals-*")) - before
    assert spark.read.parquet(f"file:{intervals}").count() <= 60 * 12 < len(rows) / 4
    pick = ["cutoff", "knowledge", "local_values", "context_values", "current_state", "latest", "observed"]
    asks = made.select("request_id", "series", "cutoff", "knowledge")
    whole = N.snapshots(spark.createDataFrame(rows, OBS), asks, REG)
    got, want = (sorted(map(tuple, x.select(*pick).collect())) for x in (made, whole))
    assert got == want and len(got) == 12


def test_a_bucketed_history_is_not_shuffled(spark, tmp_path):
    obs = spark.createDataFrame([row("s", m, float(m)) for m in range(50)], OBS)
    history = P.store_intervals(P.validity_intervals(obs), "intervals_of_a_test", f"file:{tmp_path}/intervals", 4)
    asks = spark.createDataFrame([("s", T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 1)) for m in range(60)], "series string, timestamp timestamp, knowledge timestamp")
    joined = P.pit_join(asks, history.hint("merge"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and joined.where("system_imbalance_mw is not null").count() == 50
    spark.sql("DROP TABLE intervals_of_a_test")


def test_runs_of_steps_over_many_chunks(spark):
    r = random.Random(21)
    seconds = {"a": sorted(r.sample(range(3000), 2950)), "b": [*range(0, 1600), *range(1601, 1603)], "c": [5], "d": [-7, -6, -5, 600, 601]}
    at = {s: [60 * i + (20 if s == "a" and i % 611 == 0 else 0) for i in own] for s, own in seconds.items()}
    rows = [(s, datetime(2026, 1, 5) + timedelta(seconds=x)) for s, own in at.items() for x in own]
    df = spark.createDataFrame(rows + rows[:50], "series string, timestamp timestamp")
    runs = G.run_lengths(df, ["series"], 60, chunk_steps=7)
    got = {(x["series"], (x["timestamp"] - datetime(2026, 1, 5)).total_seconds()): (x["run_length"], x["has_next"]) for x in runs.collect()}
    assert len(got) == len(rows)
    for s, own in at.items():
        n = 0
        for i, x in enumerate(own):
            n = n + 1 if i and x - own[i - 1] == 60 else 1
            assert got[s, x] == (n, i + 1 < len(own) and own[i + 1] - x == 60), (s, x)
    plan = runs._jdf.queryExecution().optimizedPlan().toString() + G.select_cutoffs(df, 3, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # nothing is left to do over a series


def test_seeds_do_not_depend_on_the_spans_that_are_summarised(spark):
    r = random.Random(22)
    obs = spark.createDataFrame(_revised(23), OBS)
    asks = [(str(i), "s", T0 + timedelta(minutes=r.randrange(4 * 1440)), T0 + timedelta(minutes=r.randrange(7 * 1440))) for i in range(60)]
    requests = spark.createDataFrame(asks, "request_id string, series string, before timestamp, knowledge timestamp")
    a, b = (sorted(map(tuple, P.state_seed(requests, obs, 10.0, span=span).collect())) for span in (86400, 3600))
    assert a == b and len(a) == 60
    assert P.summary_span(60) == 3600 and P.summary_span(7200) == 86400


def test_minutes_of_any_year_are_exported_and_read_once(spark, tmp_path):
    shared, first = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")), datetime(2300, 1, 1)
    lines = [f"{(first + timedelta(minutes=i)).isoformat()}+00:00;PT1M;{first.isoformat()}+00:00;Validated;;{(i * 13) % 60 - 30};;;;;5" for i in range(150)]
    (tmp_path / "far.csv").write_text("\n".join([";".join(C.CSV_COLUMNS), *lines]) + "\n")
    before = set(shared.glob("minute-rows-*"))
    out, small = f"file:{tmp_path}/dataset", Registry(local_steps=20, bin_steps=5, bins=4, min_observed=5)
    assert export_from_csv(spark, f"file:{tmp_path}/far.csv", out, small, stride=10)["examples"] == 12
    rows = spark.read.parquet(out).orderBy("cutoff").collect()
    assert [x["target_next"] for x in rows] == [float(((i + 1) * 13) % 60 - 30) for i in range(30, 149, 10)] and all(x["latest"] == float((i * 13) % 60 - 30) for i, x in zip(range(30, 149, 10), rows, strict=True))
    assert len(set(shared.glob("minute-rows-*")) - before) == 1
