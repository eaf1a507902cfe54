"""Registered queries: identity, point-in-time reads, grids, windows and scalars."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import scalars as S
from ..functions.scratch import shared_path
from ..operators import grid as G
from ..operators import pit as P
from ..operators import windows as W
from . import snapshots as N
from .base import DEADBAND, KNOWN, OBS, REGISTRY, STEP, canonical_sql, events, grid_sql, ms, observations, query, r4, table

V = "system_imbalance_mw"
BY = ["series"]


@query("evt1_event_id", """SELECT event_id, sha256('["portal","events","' || CAST(event_id AS VARCHAR) || '","1"]') AS identity FROM events""")
def _(spark, sf):
    return events(spark, sf).select("event_id", I.event_id(F.lit("portal"), F.lit("events"), F.col("event_id"), F.lit("1")).alias("identity"))


@query(
    "evt2_evt3_revisioned_key",
    """WITH k AS (SELECT event_id, '{"event_type":"' || event_type || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z","user_id":' || CAST(user_id AS VARCHAR) || '}' AS dimension_key, props FROM events)
    SELECT event_id, dimension_key, dimension_key || ':' || sha256(props) AS revision_key FROM k""",
)
def _(spark, sf):
    e = events(spark, sf).withColumn("dimension_key", I.dimension_key("ts", "event_type", "user_id"))
    return e.select("event_id", "dimension_key", I.revisioned_key("dimension_key", "props").alias("revision_key"))


@query("evt4_evt5_row_version", f"WITH {OBS} SELECT event_id, epoch_ms(ingested_at) AS ingested_ms, rv AS row_version FROM obs")
def _(spark, sf):
    return observations(spark, sf).select("event_id", ms("ingested_at", "ingested_ms"), "row_version")


@query("src7_time_range", "SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def _(spark, sf):
    return P.time_range(events(spark, sf), "2024-01-05", "2024-01-12", "ts").select("event_id", ms("ts", "ts_ms"))


@query("src8_versions", f"WITH {OBS} SELECT series, epoch_ms(t) AS t_ms, event_id, rv AS row_version FROM obs WHERE t >= TIMESTAMP '2024-01-05' AND t <= TIMESTAMP '2024-01-25' AND ingested_at <= TIMESTAMP '{KNOWN}'")
def _(spark, sf):
    return P.versions(observations(spark, sf), "2024-01-05", "2024-01-25", KNOWN).select("series", ms("timestamp", "t_ms"), "event_id", "row_version")


@query("flt1_agg1_canonical_latest", f"{canonical_sql(KNOWN)} SELECT series, epoch_ms(t) AS t_ms, event_id, round(v, 4) + 0.0 AS v, quality, round(ace, 4) AS ace FROM can")
def _(spark, sf):
    c = P.canonical_latest(observations(spark, sf), knowledge=KNOWN)
    return c.select("series", ms("timestamp", "t_ms"), "event_id", r4(V, "v"), F.col("quality_status").alias("quality"), r4("ace_mw", "ace"))


@query("agg1_latest_lineitem", "SELECT l_orderkey, arg_max(l_partkey, {'a': l_shipdate, 'b': l_linenumber, 'c': l_partkey}) AS l_partkey, arg_max(l_linenumber, {'a': l_shipdate, 'b': l_linenumber, 'c': l_partkey}) AS l_linenumber FROM lineitem GROUP BY l_orderkey")
def _(spark, sf):
    return P.latest_revision(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey"], ["l_orderkey", "l_partkey", "l_linenumber"])


@query("agg2_window_known", f"{canonical_sql(KNOWN)} SELECT series, epoch_ms(t) AS t_ms, round(v, 4) + 0.0 AS v FROM can WHERE t > TIMESTAMP '2024-01-18' - INTERVAL {40 * STEP} SECOND AND t <= TIMESTAMP '2024-01-18'")
def _(spark, sf):
    return P.window_known(observations(spark, sf), "2024-01-18", 40, KNOWN, STEP).select("series", ms("timestamp", "t_ms"), r4(V, "v"))


def _requests(spark, sf, lags=(0, 86400)):
    """Requests for each series and day, with different knowledge."""
    days = observations(spark, sf).select("series", F.date_trunc("DAY", "timestamp").alias("before")).distinct()
    lag = F.explode(F.array(*map(F.lit, lags)))
    return days.select("series", "before", lag.alias("lag")).select(F.concat_ws("|", "series", F.date_format("before", "yyyyMMdd"), F.col("lag").cast("string")).alias("request_id"), "series", "before", S.shift(F.col("before"), F.col("lag")).alias("knowledge"))


_REQ = """req AS (SELECT series || '|' || strftime(before, '%Y%m%d') || '|' || CAST(lag AS VARCHAR) AS request_id, series, before, before + to_seconds(lag) AS knowledge FROM (SELECT DISTINCT series, CAST(date_trunc('day', t) AS TIMESTAMP) AS before FROM obs) CROSS JOIN (VALUES (0), (86400)) AS l(lag))"""


@query(
    "agg5_state_seed",
    f"""WITH {OBS}, {_REQ},
    latest AS (SELECT request_id, t, arg_max(v, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS v FROM req JOIN obs USING (series) WHERE t <= before AND ingested_at <= knowledge GROUP BY 1, 2),
    sg AS (SELECT *, lag(s, 1, 0) OVER (PARTITION BY request_id ORDER BY t) AS was FROM (SELECT request_id, t, CASE WHEN v > 10 THEN 1 WHEN v < -10 THEN -1 END AS s FROM latest) WHERE s IS NOT NULL),
    st AS (SELECT request_id, arg_max(s, t) AS sign, max(CASE WHEN s <> was THEN t END) AS since FROM sg GROUP BY 1), la AS (SELECT request_id, max(t) AS last FROM latest GROUP BY 1)
    SELECT request_id, series, CAST(sign AS INTEGER) AS sign, epoch_ms(since) AS since_ms, epoch_ms(last) AS last_ms FROM req LEFT JOIN st USING (request_id) LEFT JOIN la USING (request_id)""",
)
def state_seed(spark, sf):
    s = P.state_seed(_requests(spark, sf), observations(spark, sf), DEADBAND)
    return s.select("request_id", "series", "sign", ms("state_since", "since_ms"), ms("last_observed_at", "last_ms"))


_CORRECTED = f"""{OBS}, obs2 AS (SELECT series, t, v, ingested_at, event_id, rv FROM obs UNION ALL SELECT series, t, -v, ingested_at + INTERVAL 40 DAY, event_id || 'c', rv + CAST(3456000000 AS BIGINT) * 1048576 FROM obs WHERE date_trunc('day', t) = TIMESTAMP '2024-01-01')"""


def corrected(spark, sf):
    """Observations, and a correction of each of the first day's forty days later."""
    o = observations(spark, sf)
    late = o.where(F.date_trunc("DAY", "timestamp") == F.lit("2024-01-01").cast("timestamp"))
    changes = {V: -F.col(V), "ingested_at": F.timestamp_millis(F.unix_millis("ingested_at") + 3_456_000_000), "event_id": F.concat("event_id", F.lit("c")), "row_version": F.col("row_version") + 3_456_000_000 * 1048576}
    return o.unionByName(late.withColumns(changes))


@query(
    "agg5_corrected_seed",
    f"""WITH {_CORRECTED}, {_REQ.replace("(VALUES (0), (86400))", "(VALUES (0), (86400), (4320000))").replace("FROM obs)", "FROM obs2)")},
    latest AS (SELECT request_id, t, arg_max(v, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS v FROM req JOIN obs2 USING (series) WHERE t <= before AND ingested_at <= knowledge GROUP BY 1, 2),
    sg AS (SELECT *, lag(s, 1, 0) OVER (PARTITION BY request_id ORDER BY t) AS was FROM (SELECT request_id, t, CASE WHEN v > 10 THEN 1 WHEN v < -10 THEN -1 END AS s FROM latest) WHERE s IS NOT NULL),
    st AS (SELECT request_id, arg_max(s, t) AS sign, max(CASE WHEN s <> was THEN t END) AS since FROM sg GROUP BY 1), la AS (SELECT request_id, max(t) AS last FROM latest GROUP BY 1)
    SELECT request_id, series, CAST(sign AS INTEGER) AS sign, epoch_ms(since) AS since_ms, epoch_ms(last) AS last_ms FROM req LEFT JOIN st USING (request_id) LEFT JOIN la USING (request_id)""",
)
def _(spark, sf):
    """Seeds when the first day is corrected last of all: days after it are read no more than before."""
    s = P.state_seed(_requests(spark, sf, (0, 86400, 4_320_000)), corrected(spark, sf), DEADBAND)
    return s.select("request_id", "series", "sign", ms("state_since", "since_ms"), ms("last_observed_at", "last_ms"))


_IV = """run AS (SELECT series, t, ingested_at, max({'a': rv, 'b': ingested_at, 'c': event_id, 'v': v}) OVER (PARTITION BY series, t ORDER BY ingested_at RANGE UNBOUNDED PRECEDING) AS best FROM obs),
 one AS (SELECT series, t, ingested_at, any_value(best) AS best FROM run GROUP BY 1, 2, 3), ch AS (SELECT *, lag(best) OVER (PARTITION BY series, t ORDER BY ingested_at) AS was FROM one),
 iv AS (SELECT series, t, ingested_at AS valid_from, lead(ingested_at) OVER (PARTITION BY series, t ORDER BY ingested_at) AS valid_to, best.c AS event_id, best.v AS v FROM ch WHERE was IS NULL OR was <> best)"""


@query("win14_validity_intervals", f"WITH {OBS}, {_IV} SELECT series, epoch_ms(t) AS t_ms, epoch_ms(valid_from) AS from_ms, epoch_ms(valid_to) AS to_ms, event_id, round(v, 4) + 0.0 AS v FROM iv")
def _(spark, sf):
    i = P.validity_intervals(observations(spark, sf))
    return i.select("series", ms("timestamp", "t_ms"), ms("valid_from", "from_ms"), ms("valid_to", "to_ms"), "event_id", r4(V, "v"))


_PIT = f"""WITH {OBS}, {_REQ}, want AS (SELECT request_id, series, knowledge, unnest(generate_series(before - INTERVAL {11 * STEP} SECOND, before, INTERVAL {STEP} SECOND)) AS t FROM req)
    SELECT w.request_id, epoch_ms(w.t) AS t_ms, round(arg_max(o.v, {{'a': rv, 'b': ingested_at, 'c': event_id}}), 4) + 0.0 AS v FROM want w LEFT JOIN obs o ON o.series = w.series AND o.t = w.t AND o.ingested_at <= w.knowledge GROUP BY 1, 2"""


def _wanted(spark, sf):
    want = _requests(spark, sf).withColumn("timestamp", F.explode(S.minute_range(S.shift(F.col("before"), -11 * STEP), F.col("before"), STEP)))
    return want.select("request_id", "series", "knowledge", "timestamp")


@query("jn9_pit_join", _PIT)
def _(spark, sf):
    return P.pit_join(_wanted(spark, sf), P.validity_intervals(observations(spark, sf))).select("request_id", ms("timestamp", "t_ms"), r4(V, "v"))


@query("jn9_bucketed_history", _PIT)
def _(spark, sf):
    """The same join, with a history that is bucketed by its keys and not shuffled."""
    history = P.store_intervals(P.validity_intervals(observations(spark, sf)), f"intervals_{uuid.uuid4().hex}", shared_path(spark, "intervals"), 8)
    return P.pit_join(_wanted(spark, sf), history.hint("merge")).select("request_id", ms("timestamp", "t_ms"), r4(V, "v"))


def dense(spark, sf, known=None):
    c = P.canonical_latest(observations(spark, sf), knowledge=known)
    return G.dense_grid(c.select("series", "timestamp", *N.RAW), BY, STEP)


@query("jn5_dense_grid", f"{grid_sql()} SELECT series, epoch_ms(t) AS t_ms, round(v, 4) + 0.0 AS v FROM grid")
def _(spark, sf):
    return dense(spark, sf).select("series", ms("timestamp", "t_ms"), r4(V, "v"))


_STATES = f"""{grid_sql()}, s1 AS (SELECT *, last_value(CASE WHEN v > 10 THEN 1 WHEN v < -10 THEN -1 END IGNORE NULLS) OVER w AS sign, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER w AS seen FROM grid WINDOW w AS (PARTITION BY series ORDER BY t)),
 s2 AS (SELECT *, CASE WHEN sign IS NOT NULL AND sign IS DISTINCT FROM lag(sign) OVER (PARTITION BY series ORDER BY t) THEN t END AS ch FROM s1), s3 AS (SELECT *, last_value(ch IGNORE NULLS) OVER (PARTITION BY series ORDER BY t) AS since FROM s2)
 SELECT series, epoch_ms(t) AS t_ms, CAST(sign AS INTEGER) AS sign, epoch_ms(since) AS since_ms, (epoch_ms(t) - epoch_ms(since)) / {STEP}000.0 AS duration, (epoch_ms(t) - epoch_ms(seen)) / {STEP}000.0 AS age FROM s3"""


def _states(df):
    return df.select("series", ms("timestamp", "t_ms"), F.col("state_sign").cast("int").alias("sign"), ms("state_since", "since_ms"), F.col("state_duration").alias("duration"), "age")


@query("win1_win3_win4_states", _STATES)
def _(spark, sf):
    return _states(W.states(dense(spark, sf), BY, V, DEADBAND, STEP))


@query("eng1_two_level_scan", _STATES)
def _(spark, sf):
    return _states(W.two_level_states(dense(spark, sf), BY, V, DEADBAND, STEP))


@query(
    "win2_transitions",
    f"{canonical_sql()}, s AS (SELECT series, t, CASE WHEN v > 10 THEN 1 WHEN v < -10 THEN -1 END AS sign FROM can) SELECT series, epoch_ms(t) AS t_ms, CAST(sign AS INTEGER) AS sign, CAST(was AS INTEGER) AS was FROM (SELECT *, lag(sign, 1, 0) OVER (PARTITION BY series ORDER BY t) AS was FROM s WHERE sign IS NOT NULL) WHERE sign <> was",
)
def _(spark, sf):
    t = W.transitions(P.canonical_latest(observations(spark, sf)), BY, V, DEADBAND)
    return t.select("series", ms("timestamp", "t_ms"), F.col("sign").cast("int").alias("sign"), F.col("previous_sign").cast("int").alias("was"))


def _over(n):
    return f"OVER (PARTITION BY series ORDER BY t ROWS {n - 1} PRECEDING)"


def _full(expr, n):
    return f"CASE WHEN count(v) {_over(n)} = {n} THEN {expr} END"


@query(
    "win5_win11_deltas",
    f"{grid_sql()} SELECT series, epoch_ms(t) AS t_ms, round(v - a, 4) + 0.0 AS d1, round(v - b, 4) + 0.0 AS d2, round((v - a) - (a - b), 4) + 0.0 AS acc, round(abs(abs(v) - 10), 4) AS boundary FROM (SELECT *, lag(v, 1) OVER (PARTITION BY series ORDER BY t) AS a, lag(v, 2) OVER (PARTITION BY series ORDER BY t) AS b FROM grid)",
)
def _(spark, sf):
    d = W.deltas(V, BY)
    return dense(spark, sf).select("series", ms("timestamp", "t_ms"), r4(d["delta_1_mw"], "d1"), r4(d["delta_2_mw"], "d2"), r4(d["acceleration_mw"], "acc"), r4(F.abs(F.abs(V) - DEADBAND), "boundary"))


def _ewm_sql(n):
    a = 2.0 / (n + 1)
    return "round(" + _full(f"list_reduce(list(v) {_over(n)}, lambda x, y: {a!r} * y + {1 - a!r} * x)", n) + ", 4) + 0.0"


@query("win6_ewm", f"{grid_sql()} SELECT series, epoch_ms(t) AS t_ms, {_ewm_sql(5)} AS e5, {_ewm_sql(15)} AS e15, {_ewm_sql(60)} AS e60 FROM grid")
def _(spark, sf):
    return dense(spark, sf).select("series", ms("timestamp", "t_ms"), *[r4(W.ewm(V, n, BY), f"e{n}") for n in (5, 15, 60)])


def _median_sql(n):
    return "round(" + _full(f"quantile_cont(v, 0.5) {_over(n)}", n) + ", 4) + 0.0"


@query("win7_win8_rolling", f"{grid_sql()} SELECT series, epoch_ms(t) AS t_ms, {_median_sql(5)} AS m5, {_median_sql(15)} AS m15, round({_full('min(v) ' + _over(15), 15)}, 4) + 0.0 AS lo, round({_full('max(v) ' + _over(15), 15)}, 4) + 0.0 AS hi FROM grid")
def _(spark, sf):
    lo, hi = W.rolling_extremes(V, 15, BY)
    return dense(spark, sf).select("series", ms("timestamp", "t_ms"), r4(W.rolling_median(V, 5, BY), "m5"), r4(W.rolling_median(V, 15, BY), "m15"), r4(lo, "lo"), r4(hi, "hi"))


@query("win9_slope", f"{grid_sql()}, i AS (SELECT *, epoch_ms(t) / {STEP}000.0 AS i FROM grid) SELECT series, epoch_ms(t) AS t_ms, round({_full('regr_slope(v, i) ' + _over(5), 5)} + 1e-9, 4) + 0.0 AS s5, round({_full('regr_slope(v, i) ' + _over(15), 15)} + 1e-9, 4) + 0.0 AS s15 FROM i")
def _(spark, sf):
    d = dense(spark, sf).withColumn("__i", F.unix_seconds("timestamp") / float(STEP))
    return d.select("series", ms("timestamp", "t_ms"), r4(W.slope(V, 5, BY) + 1e-9, "s5"), r4(W.slope(V, 15, BY) + 1e-9, "s15"))


def _mad_sql(n):
    items = f"list(v) {_over(n)}"
    return f"CASE WHEN count(v) {_over(n)} = {n} THEN {items} END AS l{n}"


def _mad(n):
    return f"round(1.4826 * list_aggregate(list_transform(l{n}, lambda x: abs(x - list_aggregate(l{n}, 'median'))), 'median') + 1e-9, 4) + 0.0"


@query("win10_robust_scale", f"{grid_sql()}, l AS (SELECT series, t, {_mad_sql(15)}, {_mad_sql(60)} FROM grid) SELECT series, epoch_ms(t) AS t_ms, {_mad(15)} AS r15, {_mad(60)} AS r60 FROM l")
def _(spark, sf):
    return dense(spark, sf).select("series", ms("timestamp", "t_ms"), r4(W.robust_scale(V, 15, BY) + 1e-9, "r15"), r4(W.robust_scale(V, 60, BY) + 1e-9, "r60"))


_BIN = 12 * STEP


@query(
    "agg6_right_closed_bins",
    f"""{canonical_sql()} SELECT series, ((epoch_ms(t) // 1000 - {STEP}) // {_BIN}) * {_BIN} * 1000 + {_BIN} * 1000 AS bin_end_ms, round(avg(v), 4) + 0.0 AS mean, round(min(v), 4) + 0.0 AS lo, round(max(v), 4) + 0.0 AS hi, round(stddev_pop(v), 4) + 0.0 AS std, count(*) AS observed FROM can GROUP BY 1, 2""",
)
def _(spark, sf):
    b = G.right_closed_bins(P.canonical_latest(observations(spark, sf)), 12, BY, STEP)
    return b.select("series", ms("bin_end", "bin_end_ms"), r4("mean", "mean"), r4("min", "lo"), r4("max", "hi"), r4("std", "std"), "observed")


_RUNS = f"""{canonical_sql()}, n AS (SELECT series, t, row_number() OVER (PARTITION BY series ORDER BY t) AS n, lead(t) OVER (PARTITION BY series ORDER BY t) AS nx, min(t) OVER (PARTITION BY series) AS o FROM can),
 r AS (SELECT series, t, o, row_number() OVER (PARTITION BY series, epoch_ms(t) - n * {STEP}000 ORDER BY t) AS run_length, coalesce(epoch_ms(nx) - epoch_ms(t) = {STEP}000, FALSE) AS has_next FROM n)"""


@query("win15_run_lengths", f"{_RUNS} SELECT series, epoch_ms(t) AS t_ms, CAST(run_length AS INTEGER) AS run_length, has_next FROM r")
def _(spark, sf):
    return G.run_lengths(observations(spark, sf), BY, STEP).select("series", ms("timestamp", "t_ms"), F.col("run_length").cast("int").alias("run_length"), "has_next")


_CUTS = f"{_RUNS}, c AS (SELECT series, t AS cutoff FROM r WHERE run_length >= 8 AND has_next AND ((epoch_ms(t) - epoch_ms(o)) // {STEP}000) % 3 = 0)"


@query("flt2_cutoffs", f"{_CUTS} SELECT series, epoch_ms(cutoff) AS cutoff_ms FROM c")
def cutoffs(spark, sf):
    return G.select_cutoffs(observations(spark, sf), 8, 3, by=BY, step_seconds=STEP).select("series", ms("cutoff", "cutoff_ms"))


@query(
    "flt3_evenly_spaced",
    f"{_CUTS}, i AS (SELECT series, cutoff, row_number() OVER (PARTITION BY series ORDER BY cutoff) - 1 AS i, count(*) OVER (PARTITION BY series) - 1 AS last FROM c) SELECT series, epoch_ms(cutoff) AS cutoff_ms FROM i WHERE last < 7 OR i IN (SELECT CAST(round_even(k * last / 6.0, 0) AS BIGINT) FROM range(7) AS r(k))",
)
def _(spark, sf):
    return G.evenly_spaced(G.select_cutoffs(observations(spark, sf), 8, 3, by=BY, step_seconds=STEP), 7).select("series", ms("cutoff", "cutoff_ms"))


@query(
    "flt4_set2_missing_steps",
    f"{canonical_sql()} SELECT series, epoch_ms(t) AS t_ms FROM (SELECT series, unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-28', INTERVAL {STEP} SECOND)) AS t FROM (SELECT DISTINCT series FROM can)) EXCEPT SELECT series, epoch_ms(t) FROM can",
)
def _(spark, sf):
    return G.missing_steps(observations(spark, sf), "2024-01-02", "2024-01-28", BY, STEP).select("series", ms("timestamp", "t_ms"))


@query("set1_set3_distinct_union", f"WITH {OBS} SELECT DISTINCT series, epoch_ms(t) AS t_ms FROM (SELECT series, t FROM obs UNION ALL SELECT series, t + INTERVAL {STEP} SECOND FROM obs)")
def _(spark, sf):
    o = observations(spark, sf).select("series", "timestamp")
    return o.unionByName(o.select("series", S.shift(F.col("timestamp"), STEP).alias("timestamp"))).distinct().select("series", ms("timestamp", "t_ms"))


@query(
    "jn7_last_as_of",
    f"{canonical_sql()}, b AS (SELECT DISTINCT series, date_trunc('day', t) AS b FROM can) SELECT b.series, epoch_ms(b.b) AS b_ms, epoch_ms(max(c.t)) AS last_ms FROM b LEFT JOIN can c ON c.series = b.series AND c.t <= b.b GROUP BY 1, 2",
)
def _(spark, sf):
    o = observations(spark, sf).select("series", "timestamp")
    ends = o.select("series", F.date_trunc("DAY", "timestamp").alias("bin_end")).distinct()
    return G.last_as_of(o, ends).select("series", ms("bin_end", "b_ms"), ms("last", "last_ms"))


_LOCAL = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Brussels')"


@query(
    "scl1_scl4_calendar",
    f"""WITH e AS (SELECT event_id, ts, {_LOCAL} AS l FROM events), h AS (SELECT event_id, l, ts, 2 * pi() * (minute(l) % 15) / 15.0 AS q, 2 * pi() * minute(l) / 60.0 AS m, 2 * pi() * (hour(l) + minute(l) / 60.0) / 24 AS h, 2 * pi() * (isodow(l) - 1) / 7.0 AS w, 2 * pi() * (dayofyear(l) - 1) / 366.0 AS d FROM e)
    SELECT event_id, round(sin(q), 4) + 0.0 AS qs, round(cos(q), 4) + 0.0 AS qc, round(sin(m), 4) + 0.0 AS ms, round(cos(m), 4) + 0.0 AS mc, round(sin(h), 4) + 0.0 AS hs, round(cos(h), 4) + 0.0 AS hc, round(sin(w), 4) + 0.0 AS ws, round(cos(w), 4) + 0.0 AS wc,
    round(sin(d), 4) + 0.0 AS ds, round(cos(d), 4) + 0.0 AS dc, CASE WHEN isodow(l) >= 6 THEN 1.0 ELSE 0.0 END AS weekend, CASE WHEN CAST(l AS DATE) = DATE '2024-01-01' THEN 1.0 ELSE 0.0 END AS holiday, 0.0 AS dst FROM h""",
)
def _(spark, sf):
    e = S.with_holiday(events(spark, sf).select("event_id", F.col("ts").alias("cutoff")), S.holidays(spark, 2023, 2025))
    c = S.calendar(F.col("cutoff"))
    short = {"qs": "quarter_hour_phase_sin", "qc": "quarter_hour_phase_cos", "ms": "minute_phase_sin", "mc": "minute_phase_cos", "hs": "hour_phase_sin", "hc": "hour_phase_cos", "ws": "weekday_phase_sin", "wc": "weekday_phase_cos", "ds": "day_of_year_phase_sin", "dc": "day_of_year_phase_cos"}
    return e.select("event_id", *[r4(c[n], k) for k, n in short.items()], c["is_weekend"].alias("weekend"), F.col("is_holiday").alias("holiday"), c["is_dst_transition"].alias("dst"))


@query("scl5_scl7_floors", "SELECT event_id, (epoch_us(ts) // 900000000) * 900000 AS quarter_ms, (epoch_us(ts) // 900000000) * 900000 - (95 * 15 + 14) * 60000 AS start_ms FROM events")
def _(spark, sf):
    t = F.col("ts")
    return events(spark, sf).select("event_id", ms(S.floor_steps(t, 900), "quarter_ms"), ms(S.history_start(t), "start_ms"))


@query(
    "scl8_scl13_states_and_badges",
    """WITH s AS (SELECT event_id, CASE WHEN value > 45 THEN 'positive' WHEN value < 25 THEN 'negative' END AS a, CASE WHEN user_id % 3 = 0 THEN 'positive' WHEN user_id % 3 = 1 THEN 'negative' END AS b, minute(ts) % 15 AS m FROM events)
    SELECT event_id, a <> b AS flips, CASE WHEN a IS NULL OR b IS NULL THEN 'pending' WHEN a = b THEN 'correct' ELSE 'incorrect' END AS badge, CASE WHEN m < 5 THEN 'quarter_hour_phase_start' WHEN m < 10 THEN 'quarter_hour_phase_middle' ELSE 'quarter_hour_phase_end' END AS phase FROM s""",
)
def _(spark, sf):
    a = S.state_name(W.sign_of(F.col("value") - 35, DEADBAND))
    b = F.when(F.col("user_id") % 3 == 0, "positive").when(F.col("user_id") % 3 == 1, "negative")
    return events(spark, sf).select("event_id", S.flip(a, b).alias("flips"), S.result_badge(a, b).alias("badge"), S.phase_cohort(F.col("ts")).alias("phase"))


@query("scl9_scl16_quality_json", f"""WITH {OBS} SELECT event_id, lower(quality) = 'validated' AS ok, '{{"quality_status":"' || quality || '","series":"' || series || '"}}' AS body FROM obs""")
def _(spark, sf):
    return observations(spark, sf).select("event_id", S.validated(F.col("quality_status")).alias("ok"), I.canonical_json("series", "quality_status").alias("body"))


_FULL = {
    "system_imbalance_mw": ("v", "round(v, 4) + 0.0"), "ace_mw": ("ace", "round(ace, 4) + 0.0"), "imbalance_price_eur_mwh": ("price", "round(price, 4) + 0.0"), "marginal_incremental_price_eur_mwh": ("inc_price", "CAST(NULL AS DOUBLE)"),
    "marginal_decremental_price_eur_mwh": ("dec_price", "round(dec_price, 4) + 0.0"), "quality_validated": ("validated", "CASE WHEN v IS NOT NULL THEN CASE WHEN lower(quality) = 'validated' THEN 1.0 ELSE 0.0 END END"),
    "delta_1_mw": ("d1", "round(v - a, 4) + 0.0"), "delta_2_mw": ("d2", "round(v - b, 4) + 0.0"), "acceleration_mw": ("acc", "round((v - a) - (a - b), 4) + 0.0"),
    **{f"ewm_{n}_mw": (f"e{n}", _ewm_sql(n)) for n in (5, 15, 60)}, **{f"rolling_median_{n}_mw": (f"m{n}", _median_sql(n)) for n in (5, 15)}, **{f"robust_scale_{n}_mw": (f"r{n}", _mad(n)) for n in (15, 60)},
    **{f"slope_{n}_mw_per_minute": (f"s{n}", f"round({_full(f'regr_slope(v, i) {_over(n)}', n)} + 1e-9, 4) + 0.0") for n in (5, 15)},
    "rolling_min_15_mw": ("lo", f"round({_full('min(v) ' + _over(15), 15)}, 4) + 0.0"), "rolling_max_15_mw": ("hi", f"round({_full('max(v) ' + _over(15), 15)}, 4) + 0.0"), "boundary_distance_mw": ("boundary", "round(abs(abs(v) - 10), 4)"),
    "confirmed_state_sign": ("sign", "CAST(sign AS DOUBLE)"), "state_duration_minutes": ("duration", f"(epoch_ms(t) - epoch_ms(since)) / {STEP}000.0"), "imbalance_age_minutes": ("age", f"(epoch_ms(t) - epoch_ms(seen)) / {STEP}000.0"),
}
_NUDGED = ("robust_scale_15_mw", "robust_scale_60_mw", "slope_5_mw_per_minute", "slope_15_mw_per_minute")


@query(
    "fea1_minute_features",
    f"""{grid_sql(KNOWN)}, s1 AS (SELECT *, epoch_ms(t) / {STEP}000.0 AS i, lag(v, 1) OVER w AS a, lag(v, 2) OVER w AS b, last_value(CASE WHEN v > 10 THEN 1 WHEN v < -10 THEN -1 END IGNORE NULLS) OVER w AS sign, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER w AS seen,
    {_mad_sql(15)}, {_mad_sql(60)} FROM grid WINDOW w AS (PARTITION BY series ORDER BY t)), s2 AS (SELECT *, CASE WHEN sign IS NOT NULL AND sign IS DISTINCT FROM lag(sign) OVER (PARTITION BY series ORDER BY t) THEN t END AS ch FROM s1),
    s3 AS (SELECT *, last_value(ch IGNORE NULLS) OVER (PARTITION BY series ORDER BY t) AS since FROM s2)
    SELECT series, epoch_ms(t) AS t_ms, {", ".join(f"{sql} AS {short}" for short, sql in _FULL.values())} FROM s3""",
)
def _(spark, sf):
    """All local features, over chunks of ten days with the sixty steps before each."""
    f = N.minute_features(observations(spark, sf), KNOWN, REGISTRY, chunk_steps=120)
    return f.select("series", ms("timestamp", "t_ms"), *[r4(F.col(n) + 1e-9 if n in _NUDGED else n, short) for n, (short, _) in _FULL.items()])


def snapshot_requests(spark, sf):
    from .exports import requests_for

    return requests_for(G.select_cutoffs(observations(spark, sf), 1, 6, by=BY, step_seconds=STEP), knowledge_lag=5400)


def _flat(df):
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))
    r2 = lambda c, name: (F.round(c, 2) + 0.0).alias(name)
    sizes = [F.size(f"{g}_values").alias(f"{g}_size") for g in ("local", "context", "static")]
    last = [r2(F.when(F.get("local_masks", at) == 1, F.get("local_values", at)).cast("double"), f"last_{short}") for i, short in enumerate(_LAST) for at in [F.size("local_values") - len(REGISTRY.local) + i]]
    bins = [r2(F.when(F.get("context_masks", at) == 1, F.get("context_values", at)).cast("double"), f"bin_{short}") for i, short in enumerate(_BINS) for at in [F.size("context_values") - 19 + i]]
    return df.select("series", ms("cutoff", "cutoff_ms"), "model_eligible", "current_state", *sizes, *[r2(total(f"{g}_{k}"), f"{g}_{k}_sum") for g in ("local", "context") for k in ("values", "masks")], r4("latest", "latest"), *last, *bins)


_LAST = [short for short, _ in _FULL.values()]
_BINS = ("mean", "min", "max", "std", "age")


def _part(sql):
    """The features' SQL with windows over a request's history."""
    return sql.replace("PARTITION BY series", "PARTITION BY id")


def _snapshot_sql():
    full = {short: _part(sql) for short, sql in _FULL.values()}
    f32 = lambda x: f"CAST(CAST(coalesce({x}, 0) AS FLOAT) AS DOUBLE)"
    plain = {n: x.removeprefix("round(").removesuffix(", 4) + 0.0").removesuffix(", 4)").removesuffix(" + 1e-9") if x.startswith("round(") else x for n, x in full.items()}
    r = REGISTRY
    start = f"(epoch_ms(cutoff) // {r.bin_steps * STEP * 1000}) * {r.bin_steps * STEP} - {(r.bins * r.bin_steps - 1) * STEP}"
    w = "PARTITION BY id ORDER BY t"
    return f"""WITH {OBS}, d AS (SELECT DISTINCT series, t FROM obs), n AS (SELECT series, t, lead(t) OVER (PARTITION BY series ORDER BY t) AS nx, min(t) OVER (PARTITION BY series) AS o FROM d),
 req AS (SELECT row_number() OVER () AS id, series, t AS cutoff, t + INTERVAL 5400 SECOND AS k FROM n WHERE epoch_ms(nx) - epoch_ms(t) = {STEP}000 AND ((epoch_ms(t) - epoch_ms(o)) // {STEP}000) % 6 = 0),
 ask AS (SELECT *, make_timestamp(({start}) * 1000000) AS begin FROM req),
 known AS (SELECT a.id, o.t, any_value(a.begin) AS begin, arg_max({{'v': v, 'quality': quality, 'ace': ace, 'price': price, 'dec_price': dec_price}}, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS r FROM ask a JOIN obs o ON o.series = a.series AND o.t <= a.cutoff AND o.ingested_at <= a.k GROUP BY 1, 2),
 sg AS (SELECT *, lag(s, 1, 0) OVER (PARTITION BY id ORDER BY t) AS was FROM (SELECT id, t, CASE WHEN r.v > 10 THEN 1 WHEN r.v < -10 THEN -1 END AS s FROM known WHERE t < begin) WHERE s IS NOT NULL),
 st AS (SELECT id, arg_max(s, t) AS seed_sign, max(CASE WHEN s <> was THEN t END) AS seed_since FROM sg GROUP BY 1), la AS (SELECT id, max(t) AS seed_last FROM known WHERE t < begin GROUP BY 1),
 grid AS (SELECT g.id, g.cutoff, g.t, r.v, r.quality, r.ace, r.price, r.dec_price, seed_sign, seed_since, seed_last FROM (SELECT id, cutoff, unnest(generate_series(begin, cutoff, INTERVAL {STEP} SECOND)) AS t FROM ask) g LEFT JOIN known USING (id, t) LEFT JOIN st USING (id) LEFT JOIN la USING (id)),
 s1 AS (SELECT *, epoch_ms(t) / {STEP}000.0 AS i, lag(v, 1) OVER w AS a, lag(v, 2) OVER w AS b, coalesce(last_value(CASE WHEN v > 10 THEN 1 WHEN v < -10 THEN -1 END IGNORE NULLS) OVER w, seed_sign) AS sign, coalesce(last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER w, seed_last) AS seen,
  {_part(_mad_sql(15))}, {_part(_mad_sql(60))} FROM grid WINDOW w AS ({w})),
 s2 AS (SELECT *, CASE WHEN sign IS NOT NULL AND sign IS DISTINCT FROM coalesce(lag(sign) OVER ({w}), seed_sign) THEN t END AS ch FROM s1), s3 AS (SELECT *, coalesce(last_value(ch IGNORE NULLS) OVER ({w}), seed_since) AS since FROM s2),
 f AS (SELECT id, cutoff, t, v AS own, sign AS state, {", ".join(f"{x} AS {n}_" for n, x in plain.items())} FROM s3),
 loc AS (SELECT id, CAST(count(*) AS INTEGER) * {len(r.local)} AS local_size, round(sum({" + ".join(f32(n + "_") for n in plain)}), 2) + 0.0 AS local_values_sum, CAST(sum({" + ".join(f"CAST({n}_ IS NOT NULL AS INTEGER)" for n in plain)}) AS DOUBLE) AS local_masks_sum, count(own) AS observed,
  {", ".join(f"round(CAST(CAST(max(CASE WHEN t = cutoff THEN {n}_ END) AS FLOAT) AS DOUBLE), 2) + 0.0 AS last_{n}" for n in plain)}, max(CASE WHEN t = cutoff THEN state END) AS state, round(max(CASE WHEN t = cutoff THEN own END), 4) + 0.0 AS latest, max(CASE WHEN t = cutoff THEN age_ END) AS age FROM f WHERE t > cutoff - INTERVAL {r.local_steps * STEP} SECOND GROUP BY 1),
 bins AS (SELECT id, (epoch_ms(cutoff) // {r.bin_steps * STEP * 1000} * {r.bin_steps * STEP * 1000} - epoch_ms(t)) // {r.bin_steps * STEP * 1000} AS bin, avg(own) AS mean, min(own) AS min, max(own) AS max, stddev_pop(own) AS std, arg_max({{'age': age_}}, t).age AS age FROM f WHERE epoch_ms(t) <= epoch_ms(cutoff) // {r.bin_steps * STEP * 1000} * {r.bin_steps * STEP * 1000} GROUP BY 1, 2),
 con AS (SELECT id, CAST(count(*) * 19 AS INTEGER) AS context_size, round(sum({" + ".join(f32(n) for n in _BINS)}), 2) + 0.0 AS context_values_sum, CAST(sum({" + ".join(f"CAST({n} IS NOT NULL AS INTEGER)" for n in _BINS)}) AS DOUBLE) AS context_masks_sum,
  {", ".join(f"round(CAST(CAST(max(CASE WHEN bin = 0 THEN {n} END) AS FLOAT) AS DOUBLE), 2) + 0.0 AS bin_{n}" for n in _BINS)} FROM bins GROUP BY 1)
 SELECT q.series, epoch_ms(q.cutoff) AS cutoff_ms, observed >= {r.min_observed} AND state IS NOT NULL AND coalesce(age <= {r.max_age}, false) AS model_eligible, CASE state WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' END AS current_state, local_size, context_size, 13 AS static_size,
  local_values_sum, local_masks_sum, context_values_sum, context_masks_sum, latest, {", ".join(f"last_{n}" for n in plain)}, {", ".join(f"bin_{n}" for n in _BINS)} FROM req q JOIN loc USING (id) JOIN con USING (id)"""


_SNAPSHOTS = _snapshot_sql()


@query("fea2_snapshots_online", _SNAPSHOTS)
def _(spark, sf):
    return _flat(N.snapshots(observations(spark, sf), snapshot_requests(spark, sf), REGISTRY))


@query("fea3_snapshots_replay", _SNAPSHOTS)
def _(spark, sf):
    return _flat(N.snapshots_pit(observations(spark, sf), snapshot_requests(spark, sf), REGISTRY))


@query(
    "win12_snapshot_observed",
    f"""WITH {OBS}, d AS (SELECT DISTINCT series, t FROM obs), n AS (SELECT series, t, lead(t) OVER (PARTITION BY series ORDER BY t) AS nx, min(t) OVER (PARTITION BY series) AS o FROM d),
    req AS (SELECT series, t AS cutoff, t + INTERVAL 5400 SECOND AS k FROM n WHERE epoch_ms(nx) - epoch_ms(t) = {STEP}000 AND ((epoch_ms(t) - epoch_ms(o)) // {STEP}000) % 6 = 0),
    seen AS (SELECT r.series, cutoff, o.t, arg_max(o.v, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS v FROM req r JOIN obs o ON o.series = r.series AND o.ingested_at <= r.k AND o.t <= r.cutoff AND o.t > r.cutoff - INTERVAL {24 * STEP} SECOND GROUP BY 1, 2, 3)
    SELECT r.series, epoch_ms(r.cutoff) AS cutoff_ms, count(s.t) AS observed, round(coalesce(sum(s.v), 0), 2) + 0.0 AS total, round(max(CASE WHEN s.t = r.cutoff THEN s.v END), 4) + 0.0 AS latest FROM req r LEFT JOIN seen s ON s.series = r.series AND s.cutoff = r.cutoff GROUP BY 1, 2""",
)
def _(spark, sf):
    s = N.snapshots_pit(observations(spark, sf), snapshot_requests(spark, sf), REGISTRY)
    width = len(REGISTRY.local)
    own = lambda c: F.filter(c, lambda x, i: i % width == 0)
    total = F.aggregate(own("local_values"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return s.select("series", ms("cutoff", "cutoff_ms"), F.col("observed").cast("bigint").alias("observed"), (F.round(total, 2) + 0.0).alias("total"), r4("latest", "latest"))
