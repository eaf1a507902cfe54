"""The driver's contract, and the sink stream."""

from __future__ import annotations

import json
import shutil
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from tidegrid.operators import routing as T
from tidegrid.sources import sinks as K
from tidegrid.sources.records import read_envelopes
from tidegrid.streaming import jobs as J

ROOT = Path(__file__).resolve().parents[1]


def test_entry_lists_queries_with_their_sql():
    import __spark_entry__ as entry

    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q) and len(q) > 60 and all(map(callable, q.values())) and all(isinstance(s, str) for s in sql.values())


def test_entry_works_without_the_text_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True)


def envelope(i, **changes):
    at = (datetime(2026, 1, 1) + timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    payload = {"timestamp": at, "quarter_hour": at, "resolution_code": "PT1M", "quality_status": "Validated", "system_imbalance_mw": 1.5 * i, **changes.pop("payload", {})}
    body = {"event_id": f"e{i}", "event_type": "elia.imbalance.observed", "schema_version": "1", "source": "elia", "dataset": "ods161", "event_time": at, "ingested_at": at, "correlation_id": f"c{i}", "quality_status": "Validated", "payload": json.dumps(payload)}
    return json.dumps(body | changes)


def test_sink_stream_routes_and_survives_replay(spark, tmp_path):
    lines = [envelope(i) for i in range(6)] + [envelope(2), envelope(10, event_type="x.y"), envelope(11, schema_version="2"), envelope(12, payload={"quality_status": "DataIssue"}), envelope(13, payload={"system_imbalance_mw": None})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    root = f"file:{tmp_path}/out"
    stream = read_envelopes(spark, f"file:{tmp_path}/in", streaming=True)
    J.start_sink(stream, root, f"file:{tmp_path}/checkpoint").awaitTermination()
    rows = lambda name: K.read_committed(spark, name, root)
    assert sorted(r["event_id"] for r in rows("imbalance_observations").collect()) == [f"e{i}" for i in range(6)]
    assert rows("raw_events").count() == 6 and rows("triggers").count() == 6
    dead = {r["original_event"]["event_id"]: r["reason"] for r in rows("dead_letters").collect()}
    assert dead == {"e10": "unsupported_event_type", "e11": "unsupported_schema_version", "e12": "invalid_payload", "e13": "invalid_payload"}
    assert [tuple(r) for r in J.stored_counters(spark, root).collect()] == [("elia", "ods161", 6, 4)]
    batch = read_envelopes(spark, f"file:{tmp_path}/in").dropDuplicates(["event_id"])
    J.sink_batch(root)(batch, 0)  # the same batch again
    assert rows("imbalance_observations").count() == 6


def test_batches_that_broke_off_are_not_read_and_are_written_anew(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(envelope(i) for i in range(5)))
    root, batch = f"file:{tmp_path}/out", read_envelopes(spark, f"file:{tmp_path}/in")
    half = T.typed_rows(T.route(batch), "elia.imbalance.observed").limit(2)
    K.write_typed(half, "imbalance_observations", root, batch=0)
    assert K.read_committed(spark, "imbalance_observations", root).count() == 0
    J.sink_batch(root)(batch, 1)
    assert K.read_committed(spark, "imbalance_observations", root).count() == 5
    J.sink_batch(root)(batch, 0)
    assert K.read_committed(spark, "imbalance_observations", root).count() == 10 and len(K.committed(spark, root)) == 2


def test_late_revisions_ask_for_their_own_snapshot(spark):
    t = datetime(2026, 1, 1)
    df = spark.createDataFrame([("s", t, t), ("s", t, t + timedelta(hours=1)), ("s", t, t)], "series string, timestamp timestamp, ingested_at timestamp")
    asks = J.changed_steps(df)
    assert asks.count() == 2 and asks.select("request_id").distinct().count() == 2 and asks.where(F.col("knowledge") > F.col("cutoff")).count() == 1


def test_halves_of_the_inbox_are_written_by_many_tasks(spark, tmp_path):
    from tidegrid.plans.queries_flow import _sunk

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("inbox-*"))
    e = spark.range(400).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 90).cast("double").alias("value"))
    e.coalesce(1).write.parquet(f"file:{tmp_path}/events.parquet")
    root = _sunk(spark, f"file:{tmp_path}")
    (inbox,) = set(shared.glob("inbox-*")) - before
    assert len(list(inbox.glob("*.json"))) == 2 * spark.sparkContext.defaultParallelism
    assert sum("raw_events" in tables and "imbalance_observations" in tables for tables in K.committed(spark, root).values()) == 2  # what more there is has no rows
    counts = J.stored_counters(spark, root).first()
    bad = sum(i % 17 == 0 or i % 13 == 0 or i % 19 == 0 for i in range(400))
    assert (counts["published"], counts["errors"]) == (400 - bad, bad)


def test_audit_rows_are_made_where_they_are_written(spark, tmp_path):
    from tidegrid.sources.sinks import raw_rows

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(envelope(500 * i) for i in range(8)))
    batch, root = read_envelopes(spark, f"file:{tmp_path}/in"), f"file:{tmp_path}/out"
    K.write_typed(batch.unionByName(batch), "raw_events", root, derive=raw_rows)
    own = sorted(map(tuple, raw_rows(batch).collect()))
    stored = K.read_typed(spark, "raw_events", root).drop("month")
    assert sorted(map(tuple, stored.collect())) == sorted(2 * own)
    assert K.compact_table(spark, "raw_events", root) == ["2026-01"] and K.compact_table(spark, "raw_events", root) == []
    assert sorted(map(tuple, K.read_typed(spark, "raw_events", root).drop("month").collect())) == own
    assert all(".zstd." in f for f in stored.inputFiles())


def test_payloads_are_parsed_once_under_filters(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*(envelope(i) for i in range(5)), envelope(7, payload={"quality_status": "DataIssue"})]))
    routed = T.route(read_envelopes(spark, f"file:{tmp_path}/in"))
    rows = T.typed_rows(routed, "elia.imbalance.observed")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("from_json") + plan.count("JsonToStructs") <= len(T.EVENT_TABLES)
    assert sorted(r["system_imbalance_mw"] for r in rows.collect()) == [0.0, 1.5, 3.0, 4.5, 6.0] and [r["event_id"] for r in routed.where("reason is not null").collect()] == ["e7"]


def test_sink_query_keeps_one_packed_inbox_and_its_ids_on_disk(spark, tmp_path):
    import __spark_entry__ as entry

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    e = spark.range(300).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 90).cast("double").alias("value"))
    e.write.parquet(f"file:{tmp_path}/events.parquet")
    rows = entry.queries()["st2_sink_stream"](spark, f"file:{tmp_path}").collect()
    bad = sum(i % 17 == 0 or i % 13 == 0 or i % 19 == 0 for i in range(300))
    assert sorted((k, sum(r["kind"] == k for r in rows), len({r["event_id"] for r in rows if r["kind"] == k})) for k in ("dead", "raw", "typed")) == [("dead", bad, bad), ("raw", 300 - bad, 300 - bad), ("typed", 300 - bad, 300 - bad)]
    new = {p.name.rsplit("-", 1)[0]: p for p in set(shared.iterdir()) - before}
    assert set(new) == {"inbox", "sink", "sink-checkpoint"}
    parts = [p.name for p in new["inbox"].glob("part-*")]
    assert len(parts) == 2 * spark.sparkContext.defaultParallelism and all(p.endswith(".json.gz") for p in parts)
    assert all(".zstd." in p.name for p in new["sink"].rglob("part-*")) and list(new["sink-checkpoint"].rglob("*.sst"))
