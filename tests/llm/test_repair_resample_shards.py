"""Conversation repair, importance resampling and sharding against plain Python on small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import queries, repair, resampling, sharding
from tidegrid.llm import textops as X

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture
def many_blocks(spark):
    """Ranges stay as small as they are dealt, so that conversations lie in several."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


# ---- conversations


def shown(x) -> str:
    return " " if x is None else str(x)


def after_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        own, kind = out[conv], zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else shown(role), "" if kind == 1 else re.sub("[.!?]", "", shown(text)) if kind == 2 else shown(text)
        own += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(turns):
    """Forward, all states at once, with the best (cost, audit, lines) of each."""
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in turns:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in turns if t is not None]
    follow, names = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}, {"u": "user", "a": "assistant"}
    best = {0: (0, "", ())}

    def offer(there, state, value):
        if state not in there or value[:2] < there[state][:2]:
            there[state] = value

    def inserted(there):
        for _ in range(4):
            for s, (c, a, x) in list(there.items()):
                offer(there, follow[s][1], (c + 5, a + "I", (*x, names[follow[s][0]] + ":")))
        return there

    best = inserted(best)
    for (_, role, text), fault in zip(turns, faults, strict=True):
        after: dict = {}
        for s, (c, a, x) in best.items():
            offer(after, s, (c + 2, a + "D", x))
            if fault not in ("blank", "duplicate"):
                more, (initial, to) = 5 * (fault == "truncated"), follow[s]
                if role[:1] == initial:
                    offer(after, to, (c + more, a + "K", (*x, f"{role}:{text}")))
                if role[:1] == "s" and s == 0:
                    offer(after, 1, (c + more, a + "K", (*x, f"{role}:{text}")))
                offer(after, to, (c + more + 1, a + "R", (*x, f"{names[initial]}:{text}")))
        best = inserted(after)
    cost, audit, lines = min((best[s] for s in (0, 3) if s in best), key=lambda v: v[:2])
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


CHAT = "conv_id bigint, turn bigint, role string, text string, uid string, block string, n string"


def chats(n: int, turns: int) -> list[tuple]:
    r = random.Random(n)
    texts = [None, "", " \t\n", "Ok.", "No", "Hm? ", "x\n", "Ünï.", "Long " * 30 + "."]
    own = [(r.choice([1, 1, 1, 1, 2, 3, None]), r.choice([None, *range(turns)]), r.choice(["user", "assistant", "system", "tool", "", None]), r.choice(texts), "clash", "clash", "clash") for _ in range(n)]
    alternate = [(9, i, ("user", "assistant")[i % 2], f"Turn {i}.", None, None, None) for i in range(turns)]
    return [*own, *alternate, *[(8, 5, "user", "the same.", None, None, None)] * 400, (7, None, None, None, None, None, None)]


@pytest.mark.parametrize("parts", ["4", "19"])
def test_repair(spark, many_blocks, tmp_path, parts):
    path = f"file:{tmp_path}/conversations.parquet"
    spark.createDataFrame(chats(900, 150), CHAT).write.parquet(path)
    rows = [tuple(r)[:4] for r in spark.read.parquet(path).collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = queries.op11_conversation_repair(spark, f"file:{tmp_path}")
        assert {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got.collect()} == {k: plain_repair(v) for k, v in after_damage(rows).items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repair_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], CHAT).write.parquet(f"file:{tmp_path}/conversations.parquet")
    assert queries.op11_conversation_repair(spark, f"file:{tmp_path}").collect() == []


def test_walk_from_checkpoints_and_blocks_is_the_plain_one():
    r = random.Random(5)
    for n in (0, 1, 2, 7, 40, 333):
        turns = [(r.choice("suatx"), r.choice([0, 0, 0, 1, 2]), r.choice([1, 1, 1, 3])) for _ in range(n)]
        edits, state = repair.walk(turns, 0)
        assert state in (0, 3) and sum(e == "I" for e, _ in edits) + sum(c for _, _, c in turns) == len(edits)
        cut = n // 3
        after = repair.least_cost(turns[cut:])
        first, between = repair.walk(turns[:cut], 0, after, last=False)
        assert first + repair.walk(turns[cut:], between)[0] == edits


# ---- resampling


def features(text):
    w = ALNUM.findall((text or "").translate(LOW))
    return len(w), [zlib.crc32(s.encode()) % 10000 for s in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def plain_resample(docs, items):
    own = [(d, *features(t)) for d, t in docs]
    s, t = collections.Counter(b for _, _, f in own for b in f), collections.Counter(b for x in items for b in features(x)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    rows = []
    for d, n, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((n, (d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))))
    able = sorted((r for n, r in rows if n >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = 25 * len(able) // 100
    return [(*r, i + 1 if i < k else None) for i, r in enumerate(able)] + [(*r, None) for n, r in rows if n < 20]


DOCS = "doc_id bigint, text string, n_features string, weight string, rank string, k1 string"


def test_resampling(spark, tmp_path):
    r = random.Random(3)
    words = ["the", "On", "er", "é", "Tion", "x" * 70, "9", "y" * 64, "q"]
    texts = [" ".join(r.choice(words) + r.choice(["", "", ".", "\n"]) for _ in range(r.choice([0, 1, 19, 20, 21, 60]))) for _ in range(300)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5])] * 40 + [(None, None), (None, texts[7]), (400, ""), (401, "Ab c " * 4000)]
    spark.createDataFrame([(d, t, None, "a", "b", "c") for d, t in docs], DOCS).repartition(7).write.parquet(f"file:{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, texts[3]), (2, None), (3, "the on er tion")], "item_id bigint, text string").write.parquet(f"file:{tmp_path}/benchmark.parquet")
    got = [tuple(x) for x in queries.op12_importance_resampling(spark, f"file:{tmp_path}").collect()]
    key = lambda x: str(x)
    assert sorted(got, key=key) == sorted(plain_resample(docs, [texts[3], None, "the on er tion"]), key=key)


def test_resampling_without_rows(spark):
    none = spark.createDataFrame([], DOCS)
    one = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert resampling.resample(none, one).collect() == []
    assert [tuple(r)[:2] for r in resampling.resample(one, none).collect()] == [(1, 5)]
    with pytest.raises(TypeError):
        resampling.resample(one.withColumn("doc_id", F.col("doc_id").cast("string")), one)


def test_features_are_hashed_as_whole_strings():
    text = "abc d ef ghijklmnop " + "z" * 64 + " " + "w" * 65 + " u " + "y" * 500 + " ünï a"
    raw = np.frombuffer(text.encode(), np.uint8)
    one, two = resampling.feature_buckets(raw, X.words(raw, np.array([0, len(raw)]), X.table("alnum")))
    w = text.split()
    assert one.tolist() == [zlib.crc32(s.encode()) % 10000 for s in w]
    assert two[:-1].tolist() == [zlib.crc32(f"{a} {b}".encode()) % 10000 for a, b in zip(w, w[1:], strict=False)]


def test_ranks_when_a_third_of_all_rows_have_one_key(spark):
    rows = spark.range(6000).selectExpr("if(id % 3 = 0, 7, (id * 7919) % 4001 - 2000) as a", "if(id % 3 = 0, -1, id) as b").repartition(6)
    got = [tuple(r) for r in resampling.ranked(rows, ["a", "b"]).orderBy("rank").collect()]
    assert [r[2] for r in got] == list(range(1, 6001)) and [r[:2] for r in got] == sorted(r[:2] for r in got)


# ---- shards


def test_shards(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 9), "en", i, "clash", "clash") for i in range(700)] + [(None, None, None, None, None, None)] * 300 + [(1, "", "x", 1, "", "")] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, slot bigint, row string, bucket string")
    df.repartition(5).write.parquet(f"file:{tmp_path}/a")
    df.repartition(2, "doc_id").write.parquet(f"file:{tmp_path}/b")
    a = sharding.shuffle_into_shards(spark.read.parquet(f"file:{tmp_path}/a"), 24, bucket_bytes=2000)
    got = a.collect()
    assert sorted(map(str, (tuple(r["row"]) for r in got))) == sorted(map(str, rows))
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and {len(s) for s in slots.values()} <= {41, 42} and len(slots) == 24
    # 300 equal rows are scattered as all others
    null = collections.Counter(r["shard"] for r in got if r["row"]["doc_id"] is None)
    assert len(null) > 20 and max(null.values()) < 30
    # the order is far from that of doc_id
    place = {r["row"]["doc_id"]: r["shard"] * 42 + r["slot"] for r in got if r["row"]["doc_id"] is not None}
    assert abs(np.corrcoef(list(place), list(place.values()))[0, 1]) < 0.2


def test_shards_do_not_depend_on_the_cluster(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i} " * (i % 9)) for i in range(500)], "doc_id bigint, text string")
    df.repartition(5).write.parquet(f"file:{tmp_path}/a")
    df.repartition(2, "doc_id").write.parquet(f"file:{tmp_path}/b")
    out = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for name, parts in (("a", before), ("b", before), ("a", "7")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out.append(sorted((r[0], r[1], r[2]) for r in sharding.shuffle_into_shards(spark.read.parquet(f"file:{tmp_path}/{name}"), 5, bucket_bytes=2000).select("row.doc_id", "shard", "slot").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] == out[2]
    other = sharding.shuffle_into_shards(df, 5, seed=1, bucket_bytes=2000).select("row.doc_id", "shard", "slot").collect()
    assert sorted((r[0], r[1], r[2]) for r in other) != out[0]


def test_few_rows_and_no_rows_make_shards(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id bigint, text string")
    assert sorted(r["slot"] for r in sharding.shuffle_into_shards(df, 24).collect()) == [0, 0]
    assert sharding.shuffle_into_shards(df.where("false"), 24).collect() == []
