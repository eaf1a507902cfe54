"""Registered queries: sources, sinks, routing and weather, over files that Spark derives from the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions.scratch import shared_path, written
from ..functions.schemas import Registry
from ..operators import routing as T
from ..operators.pit import canonical_latest
from ..sources import records as C
from ..sources import sinks as K
from .base import OBS, STEP, events, ms, observations, query, r4


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def _text(c):
    return c.cast("decimal(18,4)").cast("string")


@query(
    "src1_minute_csv",
    "WITH e AS (SELECT date_trunc('minute', ts) AS t, max(value) AS v, max(user_id) AS u FROM events GROUP BY 1) SELECT epoch_ms(t) AS t_ms, round(v - 35, 4) + 0.0 AS v, CASE WHEN u % 3 <> 0 THEN round(CAST(u AS DOUBLE), 4) END AS ace FROM e",
)
def _(spark, sf):
    e = events(spark, sf).groupBy(F.date_trunc("MINUTE", "ts").alias("t")).agg(F.max("value").alias("v"), F.max("user_id").alias("u"))
    values = {
        "Datetime": _iso(F.col("t")), "Resolution code": F.lit("PT1M"), "Quarter hour": _iso(F.col("t")), "Quality status": F.lit("Validated"), "ACE": F.when(F.col("u") % 3 != 0, F.col("u").cast("string")).otherwise(" "),
        "System imbalance": _text(F.col("v") - 35), "Alpha": F.lit(""), "Alpha'": F.lit(""), "Marginal incremental price": F.lit(""), "Marginal decremental price": F.lit(""), "Imbalance Price": _text(F.col("v")),
    }
    path = shared_path(spark, "portal-csv")
    e.select(*[values[k].alias(k) for k in C.CSV_COLUMNS]).write.csv(path, sep=";", header=True)
    return C.read_minute_csv(spark, path).select(ms("timestamp", "t_ms"), r4("system_imbalance_mw", "v"), r4("ace_mw", "ace"))


def _pages(df, fields, spark, name):
    """Records by pages of a hundred, each a line of JSON: files grow with the table's partitions, not with its pages."""
    path = shared_path(spark, name)
    record = F.struct(*[F.col(k) for k in fields])
    df.withColumn("page", F.floor(F.col("k") / 100)).groupBy("page").agg(F.count(F.lit(1)).alias("total_count"), F.collect_list(record).alias("results")).select("total_count", "results").write.json(path)
    return C.read_record_pages(spark, path, fields, lines=True)


def _records(spark, sf, fields, resolution):
    e = events(spark, sf)
    own = {"datetime": _iso(F.col("ts")), "quarterhour": _iso(F.col("ts")), "resolutioncode": F.when(F.col("event_id") % 10 == 0, "PT5M").otherwise(resolution), "qualitystatus": F.lit("Validated"), "region": F.col("event_type"), "offshoreonshore": F.when(F.col("event_id") % 11 != 0, "Offshore"), "gridconnectiontype": F.lit("Elia"), "decrementalbidid": F.col("user_id").cast("string")}
    return _pages(e.select(F.col("event_id").alias("k"), *[own.get(f, _text(F.col("value") - 35)).alias(f) for f in fields]), fields, spark, "pages")


@query("src2_src3_imbalance_records", "SELECT epoch_us(ts) // 1000 AS t_ms, CASE WHEN event_id % 10 <> 0 THEN round(value - 35, 4) + 0.0 END AS v, CASE WHEN event_id % 10 = 0 THEN 'resolution' END AS reason FROM events")
def _(spark, sf):
    n = C.normalize_imbalance(_records(spark, sf, C.IMBALANCE_FIELDS, "PT1M"))
    return n.select(ms("timestamp", "t_ms"), F.when(F.col("reason").isNull(), F.round("system_imbalance_mw", 4) + 0.0).alias("v"), "reason")


@query("src4_src6_load_solar_records", "SELECT epoch_us(ts) // 1000 AS t_ms, k AS kind, round(value - 35, 4) + 0.0 AS v, CASE WHEN event_id % 10 = 0 THEN 'resolution' END AS reason FROM events, (VALUES ('load'), ('solar')) AS x(k)")
def _(spark, sf):
    load = C.normalize_load(_records(spark, sf, C.LOAD_FIELDS, "PT15M")).select(ms("timestamp", "t_ms"), F.lit("load").alias("kind"), r4("measured_mw", "v"), "reason")
    solar = C.normalize_solar(_records(spark, sf, C.SOLAR_FIELDS, "PT15M")).select(ms("timestamp", "t_ms"), F.lit("solar").alias("kind"), r4("real_time_mw", "v"), "reason")
    return load.unionByName(solar)


@query("src5_wind_records", "SELECT epoch_us(ts) // 1000 AS t_ms, event_type AS region, CAST(user_id AS VARCHAR) AS bid, CASE WHEN event_id % 10 = 0 THEN 'resolution' WHEN event_id % 11 = 0 THEN 'invalid_record' END AS reason FROM events")
def _(spark, sf):
    w = C.normalize_wind(_records(spark, sf, C.WIND_FIELDS, "PT15M"))
    return w.select(ms("timestamp", "t_ms"), "region", F.col("decremental_bid_id").alias("bid"), "reason")


def envelopes(spark, sf, parts=None):
    """An envelope for each event: every thirteenth of an unknown type, every seventeenth of another schema, every nineteenth broken.

    With ``parts``, the events are dealt to so many tasks before envelopes are made of them.
    """
    e = events(spark, sf)
    e = e.repartition(parts) if parts else e
    i = F.col("event_id")
    at = F.date_trunc("MILLISECOND", "ts")
    number = F.when(i % 19 == 0, F.lit('"x"')).otherwise(_text(F.col("value") - 35))
    stamp = I.iso_ms(at)
    payload = F.concat(F.lit('{"timestamp":"'), stamp, F.lit('","quarter_hour":"'), stamp, F.lit('","resolution_code":"PT1M","quality_status":"Validated","system_imbalance_mw":'), number, F.lit(',"ace_mw":null}'))
    return e.select(
        I.event_id(F.lit("elia"), F.lit("ods161"), i, F.lit("1")).alias("event_id"), F.when(i % 13 == 0, "other.thing").otherwise("elia.imbalance.observed").alias("event_type"), F.when(i % 17 == 0, "2").otherwise("1").alias("schema_version"),
        F.lit("elia").alias("source"), F.col("event_type").alias("dataset"), at.alias("event_time"), at.alias("observed_at"), at.alias("ingested_at"), i.cast("string").alias("correlation_id"), F.lit(None).cast("string").alias("causation_id"),
        F.lit("Validated").alias("quality_status"), payload.alias("payload"),
    )


_REASON = "CASE WHEN event_id % 17 = 0 THEN 'unsupported_schema_version' WHEN event_id % 13 = 0 THEN 'unsupported_event_type' WHEN event_id % 19 = 0 THEN 'invalid_payload' END"


def _logged(spark, sf):
    path = shared_path(spark, "envelopes")
    envelopes(spark, sf).write.json(path)
    return C.read_envelopes(spark, path)


@query("src9_evt6_routing", f"SELECT CAST(event_id AS VARCHAR) AS id, {_REASON} AS reason, CASE WHEN {_REASON} IS NULL THEN round(value - 35, 4) + 0.0 END AS v FROM events")
def _(spark, sf):
    r = T.route(_logged(spark, sf))
    return r.select(F.col("correlation_id").alias("id"), "reason", F.when(F.col("reason").isNull(), F.round("p0.system_imbalance_mw", 4) + 0.0).alias("v"))


@query("evt11_ingest_counters", f"WITH r AS (SELECT event_type AS dataset, {_REASON} AS reason FROM events) SELECT 'elia' AS source, dataset, count(*) - count(reason) AS published, count(reason) AS errors FROM r GROUP BY 2")
def _(spark, sf):
    return T.ingest_counters(T.route(envelopes(spark, sf)))


@query("evt7_evt8_vectors", "SELECT vec_id, vec_id % 5 = 0 AS bad, vec_id % 3 <> 0 OR vec_id % 2 = 0 AS meaningful FROM embeddings")
def _(spark, sf):
    from .base import table

    e = table(spark, sf, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double"))
    masks = F.transform("embedding", lambda x: F.when(F.col("vec_id") % 5 == 0, 2).otherwise(1))
    eligible, state = F.col("vec_id") % 3 == 0, F.when(F.col("vec_id") % 2 == 0, "positive")
    t = F.timestamp_seconds(F.col("vec_id"))
    return e.select("vec_id", T.vector_problem(v, masks).alias("bad"), T.snapshot_semantics(t, F.timestamp_seconds(F.col("vec_id") + 60), eligible, state).alias("meaningful"))


@query("evt9_evt10_derived_events", """SELECT sha256('["clickhouse","stored-elia-imbalance","' || sha256('["elia","ods161","' || CAST(event_id AS VARCHAR) || '","1"]') || ':' || strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z","1"]') AS event_id, sha256('["elia","ods161","' || CAST(event_id AS VARCHAR) || '","1"]') AS causation_id FROM events""")
def _(spark, sf):
    return T.stored_triggers(envelopes(spark, sf)).select("event_id", "causation_id")


@query("snk1_snk2_typed_tables", f"WITH r AS (SELECT *, {_REASON} AS reason FROM events) SELECT 'imbalance_observations' AS target, strftime(ts, '%Y-%m') AS month, count(*) AS n FROM r WHERE reason IS NULL GROUP BY 2 UNION ALL SELECT 'raw_events', strftime(ts, '%Y-%m'), count(*) FROM r WHERE reason IS NULL GROUP BY 2")
def _(spark, sf):
    root = shared_path(spark, "tables")
    routed = written(T.route(envelopes(spark, sf)), "routed")
    good = routed.where("reason is null").select(*envelopes(spark, sf).columns)
    K.write_raw_then_typed(good, {"imbalance_observations": T.typed_rows(routed, "elia.imbalance.observed")}, root)
    one = lambda t: K.read_typed(spark, t, root).groupBy("month").agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("target"), "month", "n")
    return one("imbalance_observations").unionByName(one("raw_events"))


@query("snk5_dead_letters", f"WITH r AS (SELECT *, {_REASON} AS reason FROM events) SELECT CAST(event_id AS VARCHAR) AS id, reason, 1 AS delivery_count FROM r WHERE reason IS NOT NULL")
def _(spark, sf):
    routed = T.route(envelopes(spark, sf)).where("reason is not null")
    d = K.dead_letters(routed.select(*[c for c in routed.columns if not (c[0] == "p" and c[1:].isdigit())]))
    return d.select(F.col("original_event.correlation_id").alias("id"), "reason", "delivery_count")


@query("snk6_compaction", "SELECT epoch_us(ts) // 1000 AS t_ms, count(*) AS n, '2023-12,2024-01' AS changed, '' AS changed_again FROM (SELECT DISTINCT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-11') GROUP BY 1")
def _(spark, sf):
    """A table with each row twice and a month that has expired, compacted in place, and then once more."""
    root, now = shared_path(spark, "raw"), datetime(2024, 4, 10)
    raw = envelopes(spark, sf)
    early = raw.withColumn("event_time", F.timestamp_micros(F.unix_micros("event_time") - 31 * 86_400_000_000))
    K.write_typed(raw.unionByName(raw).unionByName(early), "raw_events", root, derive=K.raw_rows)
    changed = [",".join(K.compact_table(spark, "raw_events", root, now, 90)) for _ in range(2)]
    return K.read_typed(spark, "raw_events", root).groupBy(ms("event_time", "t_ms")).agg(F.count(F.lit(1)).alias("n")).select("t_ms", "n", F.lit(changed[0]).alias("changed"), F.lit(changed[1]).alias("changed_again"))


def _by_hour(time, name):
    return F.transform(time, lambda t: F.try_element_at(F.col(name), t))


@query(
    "src10_agg7_agg8_weather",
    """WITH w AS (SELECT user_id % 5 AS loc, date_trunc('hour', ts) AS h, max(value) AS s, max(CASE WHEN event_id % 4 <> 0 THEN value END) AS d FROM events GROUP BY 1, 2),
    g AS (SELECT h, avg(s) AS mean, min(s) AS lo, max(s) AS hi, avg(sin(radians(d))) AS sn, avg(cos(radians(d))) AS cs, count(d) AS nd, count(*) AS n FROM w GROUP BY 1)
    SELECT epoch_ms(h) AS t_ms, 'wind_speed_100m' AS variable, round(mean, 4) AS mean, round(lo, 4) AS lo, round(hi, 4) AS hi, n AS points FROM g UNION ALL
    SELECT epoch_ms(h), 'wind_direction_100m', round(CASE WHEN sqrt(sn * sn + cs * cs) >= 1e-12 THEN (degrees(atan2(sn, cs)) + 360) % 360 END, 4), NULL, NULL, nd FROM g""",
)
def _(spark, sf):
    e = events(spark, sf)
    w = e.groupBy((F.col("user_id") % 5).cast("string").alias("location"), F.date_trunc("HOUR", "ts").alias("h")).agg(F.max("value").alias("wind_speed_100m"), F.max(F.when(F.col("event_id") % 4 != 0, F.col("value"))).alias("wind_direction_100m"))
    names = ("wind_speed_100m", "wind_direction_100m")
    hours = w.select(F.date_format("h", "yyyy-MM-dd'T'HH:mm").alias("h")).distinct().agg(F.array_sort(F.collect_set("h"))).first()[0]  # as many as a forecast has
    own = w.groupBy("location").agg(*[F.map_from_entries(F.collect_list(F.struct(F.date_format("h", "yyyy-MM-dd'T'HH:mm"), v))).alias(v) for v in names])
    time = F.array(*map(F.lit, hours))
    hourly = own.select("location", F.lit(0).cast("bigint").alias("utc_offset_seconds"), F.struct(time.alias("time"), *[_by_hour(time, v).alias(v) for v in names]).alias("hourly"))
    long = C.explode_weather(hourly, names)
    a = C.aggregate_weather(long)
    return a.select(ms("valid_time", "t_ms"), "variable", r4("mean", "mean"), r4("minimum", "lo"), r4("maximum", "hi"), F.size(F.filter(F.map_values("point_mask"), lambda x: x)).cast("bigint").alias("points"))


@query("flt6_available_forecasts", "SELECT event_id FROM events WHERE ts + to_minutes(CAST(user_id AS INTEGER)) <= TIMESTAMP '2024-01-15'")
def _(spark, sf):
    e = events(spark, sf).select("event_id", F.col("ts").alias("valid_time"), F.timestamp_micros(F.unix_micros("ts") + F.col("user_id") * 60_000_000).alias("received_at"))
    return C.available_forecasts(e, "2024-01-15", live=True).select("event_id")


@query("agg17_dataset_metadata", f"WITH {OBS}, c AS (SELECT DISTINCT series, t FROM obs) SELECT count(*) AS examples, epoch_ms(min(t)) AS first_ms, epoch_ms(max(t)) AS last_ms, 1 AS schemas FROM c")
def _(spark, sf):
    c = canonical_latest(observations(spark, sf)).select(F.col("timestamp").alias("cutoff"), F.lit(Registry(step_seconds=STEP).fingerprint()).alias("feature_schema_hash"))
    return K.dataset_metadata(c).select("examples", ms("first_cutoff", "first_ms"), ms("last_cutoff", "last_ms"), F.col("schemas").cast("int").alias("schemas"))


@query("snk3_snk4_export_manifest")
def _(spark, sf):
    c = canonical_latest(observations(spark, sf)).select(F.col("timestamp").alias("cutoff"), "series", "system_imbalance_mw", F.lit(Registry(step_seconds=STEP).fingerprint()).alias("feature_schema_hash"))
    path = shared_path(spark, "export")
    K.export_dataset(c, path, shards=4)
    K.verify_dataset(spark, path)
    return K.dataset_manifest(spark, path).select("rows", F.length("sha256").alias("digest_length"))


@query("snk3_export_totals", f"WITH {OBS}, c AS (SELECT DISTINCT series, t FROM obs) SELECT count(*) AS examples, count(*) AS manifest_rows, true AS digests, epoch_ms(min(t)) AS first_ms, epoch_ms(max(t)) AS last_ms FROM c")
def _(spark, sf):
    """What SQL can say of an export: the rows of its shards, read back and by its manifest."""
    c = canonical_latest(observations(spark, sf)).select(F.col("timestamp").alias("cutoff"), "series", F.lit(Registry(step_seconds=STEP).fingerprint()).alias("feature_schema_hash"))
    path = shared_path(spark, "export")
    K.export_dataset(c, path, shards=4)
    K.verify_dataset(spark, path)
    listed = K.dataset_manifest(spark, path).agg(F.sum("rows").alias("manifest_rows"), F.bool_and(F.length("sha256") == 64).alias("digests"))
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("examples"), F.min("cutoff").alias("a"), F.max("cutoff").alias("b")).crossJoin(listed).select("examples", "manifest_rows", "digests", ms("a", "first_ms"), ms("b", "last_ms"))  # one row each


_LABELLED = f"""WITH {OBS}, d AS (SELECT DISTINCT series, t FROM obs), n AS (SELECT series, t, row_number() OVER (PARTITION BY series ORDER BY t) AS n, lead(t) OVER (PARTITION BY series ORDER BY t) AS nx, min(t) OVER (PARTITION BY series) AS o FROM d),
 run AS (SELECT *, row_number() OVER (PARTITION BY series, epoch_ms(t) - n * {STEP}000 ORDER BY t) AS len FROM n), req AS (SELECT series, t AS cutoff, t + INTERVAL 5400 SECOND AS k FROM run WHERE len >= 4 AND epoch_ms(nx) - epoch_ms(t) = {STEP}000 AND ((epoch_ms(t) - epoch_ms(o)) // {STEP}000) % 12 = 0),
 lab AS (SELECT series, t, arg_max(v, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS v FROM obs GROUP BY 1, 2),
 known AS (SELECT q.series, q.cutoff, o.t, arg_max(o.v, {{'a': rv, 'b': ingested_at, 'c': event_id}}) AS v FROM req q JOIN obs o ON o.series = q.series AND o.t <= q.cutoff AND o.ingested_at <= q.k GROUP BY 1, 2, 3),
 cur AS (SELECT series, cutoff, arg_max(CASE WHEN v > 10 THEN 1 ELSE -1 END, t) FILTER (WHERE abs(v) > 10) AS s, max(CASE WHEN t = cutoff THEN v END) AS latest FROM known GROUP BY 1, 2)
 SELECT q.series, epoch_ms(q.cutoff) AS cutoff_ms, round(l.v, 4) + 0.0 AS target_next, round(l.v - coalesce(latest, 0), 4) + 0.0 AS target_delta, CASE WHEN s IS NOT NULL AND abs(l.v) > 10 AND (l.v > 10) <> (s > 0) THEN 1.0 ELSE 0.0 END AS flip_target, CASE WHEN s IS NOT NULL THEN 1.0 ELSE 0.0 END AS flip_mask, 576 AS local_size
 FROM req q JOIN lab l ON l.series = q.series AND l.t = q.cutoff + INTERVAL {STEP} SECOND LEFT JOIN cur ON cur.series = q.series AND cur.cutoff = q.cutoff"""


@query("fea5_examples_from_tables", _LABELLED)
def _(spark, sf):
    from ..operators.grid import select_cutoffs
    from .base import REGISTRY
    from .exports import examples_from_tables

    obs = observations(spark, sf)
    cutoffs = select_cutoffs(obs, 4, 12, by=["series"], step_seconds=STEP)
    e = examples_from_tables(obs, cutoffs, REGISTRY, ["series"], knowledge_lag=5400, check=False)
    return e.select("series", ms("cutoff", "cutoff_ms"), r4("target_next", "target_next"), r4("target_delta", "target_delta"), "flip_target", "flip_mask", F.size("local_values").alias("local_size"))
