"""Each text operator against plain Python on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

from __future__ import annotations

import collections
import hashlib
import math
import pathlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegrid.llm import chat, common, decontamination, graph, jaccard, langid, linededup, lmscore, quality, sentencepiece, suffixdedup, warc
from tidegrid.llm import textops as X

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, n_words string"


def prose(seed: int, n: int, syllables=("the", "on", "er", "in", "at", "é", "Tion")) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def corpus() -> list[tuple]:
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    passage = "Start " + prose(3, 60).replace("\n", "") + " end."
    texts = [
        base, base, " ".join(near), " ".join(near[:115]), prose(2, 80), "alpha beta " + passage + " gamma delta. One two three", prose(4, 20) + " " + passage + " omega", None, "", "  \n\t ", "One", "A b c", "a B c",
        prose(5, 9000), "x" * 5000, "same same same same same same same same same same same same", "Ünï cödé … ﬁ ① ▁ \x00 nul", base.upper(), "12345 !!", "line one is here\nline one is here\nother",
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], "s", None, "clash", "clash") for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, prose(6, 30), "en", None, 1, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = "file:" + str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(corpus(), DOCS).repartition(3, "text").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = "file:" + str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


def key(row) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def same(got, want) -> None:
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


# 1
BENCH = [(1, " ".join(prose(1, 120).split(" ")[10:40]), "x"), (2, "One", "x"), (3, None, "x"), (4, "…!?", "x"), (None, "A b c", "x"), (10, " ".join(prose(1, 120).split(" ")[10:40]), "y"), (5, prose(77, 20), "z")]


def brute_contamination(rows, bench):
    windows = collections.defaultdict(set)
    for item, text, _ in bench:
        w = ALNUM.findall((text or "").translate(LOW))
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i : i + n])].add(None if item is None else str(item))
    for r in rows:
        w = ALNUM.findall((r[1] or "").translate(LOW))
        hit, items = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        ids = sorted(x for x in items if x is not None)
        yield r[0], len(w), len(hit), len(ids), ids, len(hit) > 0 and 20 * len(hit) >= len(w)


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string, doc_id string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "item_ids", "contaminated"]
    same(decontamination.decontaminate(docs, bench).select(*columns).collect(), brute_contamination(corpus(), BENCH))
    same(decontamination.decontaminate(docs, bench.limit(0)).select(*columns).collect(), brute_contamination(corpus(), []))
    assert decontamination.decontaminate(none, bench).count() == 0


# 2
@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece.load_vocabulary()


def test_sentencepiece_round_trip(docs, none, vocabulary):
    got = sentencepiece.decode(sentencepiece.encode(docs, vocabulary, decoded="at_once"), vocabulary)
    assert got.columns == [*docs.columns, "ids", "at_once", "decoded"] and got.where("at_once <> decoded").count() == 0
    for r in got.select("text", "decoded", "ids").collect():
        assert r["decoded"] == (r["text"] or "")
        assert bool(r["ids"]) == bool(r["text"])
    assert sentencepiece.encode(none, vocabulary).count() == 0


def test_sentencepiece_is_the_best_segmentation(vocabulary):
    segmenter = sentencepiece.Segmenter(vocabulary)
    scores = {p: (i, s) for p, i, s in vocabulary.pieces}
    words = sorted({" " + w for w in prose(9, 150).split()} | {" ①é", "   x", " ▁a", " " + "ab" * 30, "  "})
    got = segmenter.encode_sorted(words)
    for word in words:
        best = [(0.0, [])]
        for e in range(1, len(word) + 1):
            top = None
            for s in range(e):
                piece = word[s:e]
                if piece in scores:
                    c = best[s][0] + scores[piece][1], [*best[s][1], scores[piece][0]]
                elif e - s == 1:
                    c = best[s][0] + segmenter.low, best[s][1] + [vocabulary.bytes_[b] for b in piece.encode()]
                else:
                    continue
                top = c if top is None or c[0] > top[0] else top
            best.append(top)
        assert np.frombuffer(got[word], np.int32).tolist() == best[-1][1]


# 3
def test_preferences(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "a"), (0, 2, "user", "bye"), (1, 0, "user", "hi"), (1, 1, "assistant", "b"), (2, 0, None, None), (4, 1, "assistant", "z"), (4, 0, "user", "q"), (None, 0, "user", "lost"), (4, 1, "assistant", "z")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("prompt", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.format_preferences(chat.preference_pairs(df)).collect()}
    assert set(got) == {0, 1, 2, 4}
    assert (got[0]["prompt_turns"], got[0]["prompt"]) == (1, "<|user|>\nhi<|end|>\n")
    assert (got[0]["chosen"], got[0]["rejected"]) == ("<|assistant|>\na<|end|>\n", "<|assistant|>\nb<|end|>\n")
    assert [(r["chars"], r["loss"]) for r in got[0]["chosen_runs"]] == [(14, False), (9, True)]
    assert (got[2]["prompt_turns"], got[2]["chosen"], got[2]["rejected"]) == (1, "", "")  # no assistant: equal sides
    assert (got[4]["prompt_turns"], got[4]["chosen"], got[4]["rejected"]) == (2, "<|assistant|>\nz<|end|>\n", "")  # no partner, a turn twice
    assert chat.format_preferences(chat.preference_pairs(df.limit(0))).count() == 0
    sides = spark.createDataFrame([(1, None, []), (2, [("user", "x")], None)], "conv_id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    assert {r["conv_id"]: (r["prompt"], r["chosen"], r["rejected"]) for r in chat.format_preferences(sides).collect()} == {1: ("", "", ""), 2: ("", "<|user|>\nx<|end|>\n", "")}


# 4
def test_language_sample_follows_from_the_rows_alone(spark, tmp_path):
    rows = [(i, prose(i, 30, ("the", "ing", "er") if i % 2 else ("ñu", "ció", "que")), ("aa", "bb")[i % 2 == 0]) for i in range(700)] + [(7, prose(7, 30, ("the", "ing", "er")), "aa")] * 500 + [(None, None, "aa")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    for name, n in (("a", 1), ("b", 13)):
        df.repartition(n, "text").write.parquet(f"file:{tmp_path}/{name}")
    fitted = [langid.fit(spark.read.parquet(f"file:{tmp_path}/{name}")) for name in "ab"]
    fitted.append(langid.fit(spark.read.parquet(f"file:{tmp_path}/a").coalesce(1).orderBy(F.desc("doc_id"))))
    assert [[(r.lang, r.text, r.rate) for r in f] for f in fitted] == [[(r.lang, r.text, r.rate) for r in fitted[0]]] * 3 and len(fitted[0]) == 2


def test_language_id(spark, none):
    tongues = {"aa": ("the", "ing", "er", "an"), "bb": ("ñu", "ció", "que", "os"), "cc": ("sch", "ung", "ße", "ein")}
    rows = [(i, prose(i, 40, tongues[lang]), lang) for i, lang in enumerate(sorted(tongues) * 60)]
    rows += [(900, None, "aa"), (901, "123 …!", "aa"), (902, "", "bb"), (903, prose(5, 20, tongues["bb"]), None), (903, prose(5, 20, tongues["bb"]), None), (None, prose(6, 20000, tongues["cc"]), "cc"), (904, "the", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    got = langid.identify(df, langid.fit(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert all(by[i] == lang for i, _, lang in rows[:180])
    assert [by[i] for i in (900, 901, 902, 903, None, 904)] == ["und", "und", "und", "bb", "cc", "aa"]
    assert {r["lang_pred"] for r in langid.identify(df, []).collect()} == {"und"}
    assert langid.identify(none, langid.fit(none)).count() == 0


def test_suffix_automaton_and_parser():
    text = b"abcabxabcd"
    go = langid.suffix_automaton(text)
    paths = {b""}
    stack = [(0, b"")]
    while stack:
        s, p = stack.pop()
        for c, to in go[s].items():
            paths.add(p + bytes([c]))
            stack.append((to, p + bytes([c])))
    assert paths == {text[i:j] for i in range(len(text) + 1) for j in range(i, len(text) + 1)}
    parser = langid.Parser([langid.Reference("x", text)])
    for word, phrases in ((b"abc", 1), (b"abcabxabcd", 1), (b"cabd", 2), (b"zab", 2), (b"abz", 2), (b"", 0), (b"dd" * 200, 400)):
        assert parser.phrases(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[0, 0] == phrases


# 5
def test_warc(spark):
    big = "<p>" + "é" * 200 + "</p>"
    pages = [(3, "http://a/\r\nX: y", big), (1, None, big), (2, "http://b", "small"), (4, "http://c", "small"), (5, "u", None), (6, "u", ""), (7, "u", prose(3, 4000)), (1, None, big), (None, "n", big), (8, "u", "z" * 300_000)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    folder = warc.write_warc(df, shard_bytes=4000, roll_bytes=600)
    got = warc.read_warc(spark, folder).collect()
    want = []
    for p, _, h in pages:
        data = (h or "").encode()
        first = min(q for q, _, x in pages if q is not None and (x or "") == (h or ""))
        again = len(data) >= 100 and p != first
        want.append((None if p is None else str(p), len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", str(first) if again else None))
    same([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], want)
    assert len({r["warc_file"] for r in got}) > 2
    other = warc.write_warc(df.repartition(7), shard_bytes=4000, roll_bytes=600)
    files = lambda f: sorted((r["file"], r["sha256"], r["records"]) for r in warc.read_manifest(spark, f).collect())
    assert other != folder and files(other) == files(folder)  # byte for byte, however the rows are dealt
    # a stray file of another run isn't in the manifest; files that are there whole stay, broken ones are replaced
    n, top = len(got), pathlib.Path(folder.removeprefix("file:"))
    (top / "stray.warc.gz").write_bytes(b"no gzip")
    whole, broken = sorted(top.glob("pages-*.warc.gz"))[:2]
    before = whole.stat().st_ino
    broken.write_bytes(b"x" * broken.stat().st_size)
    assert files(warc.write_warc(df, folder, shard_bytes=4000, roll_bytes=600)) == files(other) and warc.read_warc(spark, folder).count() == n
    assert whole.stat().st_ino == before and not any(p.name.startswith("_") for p in top.iterdir())
    # the folder is all that a reader needs
    top.rename(top.parent / "moved")
    assert warc.read_warc(spark, f"file:{top.parent}/moved").count() == n
    assert warc.read_warc(spark, warc.write_warc(df.limit(0))).count() == 0


def test_shards_of_an_archive_are_ranges_whatever_the_ids(spark):
    """One outlying id doesn't turn ranges into a heap; a page_id that is too large for a shard is cut by digests."""
    rows = [(i, "u", prose(i, 60)) for i in range(400)] + [(10**15, "u", "far")] + [(17, "u", prose(2000 + i, 60)) for i in range(60)] + [(None, "u", prose(3000 + i, 60)) for i in range(40)]
    folder = warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string"), shard_bytes=12_000, roll_bytes=2_000)
    ends = {}
    for r in warc.read_manifest(spark, folder).collect():
        known = lambda p: 1 << 62 if p is None else int(p)
        lo, hi = ends.get(r["shard"], (1 << 63, -1))
        ends[r["shard"]] = (min(lo, known(r["first_page"])), max(hi, known(r["last_page"])))
    order = [ends[k] for k in sorted(ends)]
    assert len(order) > 15 and all(a[1] <= b[0] for a, b in zip(order, order[1:], strict=False))
    assert warc.read_warc(spark, folder).count() == len(rows)


def test_files_roll_with_the_defaults(spark):
    r = random.Random(8)
    rows = [(i, "u", "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789<>/ ", k=600_000))) for i in range(45)]
    manifest = warc.read_manifest(spark, warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string"))).collect()
    assert len({m["shard"] for m in manifest}) == 1 and len(manifest) >= 2 and all(m["bytes"] >= 8 << 20 for m in manifest if m["part"] == 0)


# 6
def shingle_set(text) -> frozenset:
    w = SPACED.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    for i, r in enumerate(rows):
        ids = [d for d in least[find(i)] if d is not None]
        yield r[0], len(sets[i]), (min(ids) if ids else None) if sets[i] else r[0]


def test_jaccard_components(docs, none):
    got = jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    same(got, brute_components(corpus()))
    assert jaccard.near_duplicates(none).count() == 0


def test_jaccard_finds_every_link_in_a_large_noisy_group(spark, tmp_path):
    """Copies of one text with few and many changes: stars alone don't reach those that only link to each other."""
    r = random.Random(5)
    base = prose(21, 90).split(" ")
    rows = []
    for i in range(70):
        w = list(base)
        for at in r.sample(range(90), r.choice([0, 1, 2, 3, 5, 8])):
            w[at] = f"w{r.randint(0, 40)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, prose(300 + i, 60) + " " + " ".join(base[:45])) for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(f"file:{tmp_path}/d")
    got = jaccard.near_duplicates(spark.read.parquet(f"file:{tmp_path}/d")).select("doc_id", "n_shingles", "component_id").collect()
    same(got, brute_components(rows))


def test_row_numbers_hold_when_files_are_split_otherwise(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    path = "file:" + str(tmp_path / "documents.parquet")
    texts = [prose(i, 60) for i in range(40)]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts + [t + " more" for t in texts])], "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(path)
    size, real = spark.conf.get("spark.sql.files.maxPartitionBytes"), jaccard.stored

    def splits_change(df, name):
        out = real(df, name)
        if name in ("sets", "dropped"):  # as when executors come or go between two scans
            spark.conf.set("spark.sql.files.maxPartitionBytes", 2000 if name == "sets" else 5000)
        return out

    monkeypatch.setattr(jaccard, "stored", splits_change)
    monkeypatch.setattr(corpus_pipeline, "stored", splits_change)
    docs = spark.read.parquet(path)
    try:
        got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
        assert got == {i: i % 40 for i in range(80)}
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
        assert "monotonically_increasing_id" not in linededup.remove_repeats(docs)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_connected_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 130)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(40)] + [(7, 7)]
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in {n for a, b in edges if a != b for n in (a, b)}}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# 7
def test_quality_base_counts(docs, none):
    got = quality.judge(docs).collect()
    want = []
    for r in corpus():
        t = r[1] or ""
        w = SPACED.findall(t)
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        want.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)))
    same([(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got], want)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality.judge(none).count() == 0


def plain_symbols(text: str) -> list[int]:
    out = []
    for c in text.translate(LOW):
        out.append(32 if ord(c) < 33 else 48 if c in "0123456789" else ord(c) if ord(c) < 65536 else 0xD800 + ord(c) % 0x800)
    return out


class PlainKneserNey:
    """The formula over dictionaries."""

    def __init__(self, texts):
        grams = collections.Counter(g for t in texts for g in self.grams(t))
        self.orders = [grams]
        for _ in range(3):
            self.orders.append(collections.Counter(g[1:] for g in self.orders[-1]))
        self.rows = []
        for c in self.orders:
            rows = collections.defaultdict(dict)
            for g, n in c.items():
                rows[g[:-1]][g[-1]] = n
            self.rows.append(rows)
        self.d = []
        for c in self.orders:
            k = collections.Counter(c.values())
            if k[1] and k[2]:
                y = k[1] / (k[1] + 2 * k[2])
                d = (1 - 2 * y * k[2] / k[1], 2 - 3 * y * k[3] / k[2], 3 - 4 * y * k[4] / k[3] if k[3] else 1.0)
                self.d.append([min(max(x, 0.05), most) for x, most in zip(d, (0.95, 1.9, 2.9), strict=True)])
            else:
                self.d.append([0.5, 0.5, 0.5])

    @staticmethod
    def grams(text):
        s = [32, 32, 32, *plain_symbols(text)]
        return [tuple(s[i : i + 4]) for i in range(len(s) - 3)]

    def p(self, gram, at=0):
        if at == 4:
            return 1 / len(self.orders[3]) if self.orders[3] else 1 / 65536
        row, d = self.rows[at].get(gram[:-1], {}), self.d[at]
        lower = self.p(gram[1:], at + 1)
        if not row:
            return lower
        n, total = row.get(gram[-1], 0), sum(row.values())
        gamma = sum(d[min(x, 3) - 1] for x in row.values()) / total
        return (n - d[min(n, 3) - 1] if n else 0) / total + gamma * lower

    def perplexity(self, text):
        g = self.grams(text)
        return -sum(math.log10(self.p(x)) for x in g) / max(1, len(g))


@pytest.mark.parametrize("entries", [1 << 22, 700])
def test_perplexity_bands_and_kept_are_the_plain_ones(spark, docs, monkeypatch, entries):
    monkeypatch.setattr(quality, "ENTRIES", entries)  # the model in one scan or in several
    monkeypatch.setattr(quality, "_HELD", 2000)
    others = spark.createDataFrame([(1, prose(60, 50) + " 😀 q€", "en"), (2, "ßßß zzz", "fr"), (3, prose(61, 20), "xx"), (4, None, None)], "doc_id bigint, text string, lang string")
    for rows, learned in ((docs, None), (others, docs)):
        got = quality.judge(rows, learned).collect()
        given = corpus() if learned is None else [tuple(r) for r in others.collect()]
        models = {lang: PlainKneserNey([r[1] for r in corpus() if r[1] is not None and (r[2] or "") == lang]) for lang in {"en", "fr", "", "xx"}}
        per = [(models[r[2] or ""].perplexity(r[1] or ""), r) for r in given]
        spread = collections.defaultdict(list)
        for x, r in per:
            if len(SPACED.findall(r[1] or "")) >= 10:
                spread[r[2] or ""].append(math.floor(x / 0.002))
        want = []
        for x, r in per:
            own, n = sorted(spread[r[2] or ""]), len(r[1] or "")
            words = SPACED.findall(r[1] or "")
            keep = True
            if own:
                q1, q3 = (own[math.ceil(q * len(own)) - 1] * 0.002 for q in (0.25, 0.75))
                reach = (q3 + 0.002 - q1) * max(1.0, math.sqrt(1000 / max(1, n)))
                keep = q1 - quality.BELOW * reach <= x <= q3 + 0.002 + quality.ABOVE * reach
            counted = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
            covered = {j for i in range(len(words) - 4) if counted[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
            failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
            want.append((r[0], r[2] or "", len(words), round(x, 3), keep and not failed))
        same([(r["doc_id"], r["model"], r["n_words"], round(r["log_perplexity"], 3), r["kept"]) for r in got], want)


def test_quality_bands_reject_outliers(spark):
    rows = [(i, prose(i, 150), "en") for i in range(80)] + [(900, " ".join(f"zqx{i}jk#{i}" for i in range(150)), "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(df).collect()}
    assert not kept[900] and all(kept[i] for i in range(80))


def test_quality_bands_reject_junk_of_each_kind(spark):
    r = random.Random(7)
    clean = [prose(1000 + i, 300) for i in range(300)]
    junk = {k: [] for k in ("symbols", "table", "capitals", "words")}
    for i in range(5):
        w = prose(2000 + i, 300).split()
        junk["symbols"].append(" ".join(x + r.choice(["###", "$$$", "%%%"]) for x in w))
        junk["table"].append(" | ".join(w))
        junk["capitals"].append(" ".join(x.upper() + "!!" for x in w))
        junk["words"].append(" ".join(r.choice(("the the", "the", "the the the the")) for _ in range(200)))
    rows = [("clean", t, "en") for t in clean] + [(k, t, "en") for k, texts in junk.items() for t in texts]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    got = [(r["doc_id"], r["kept"], r["low"] <= r["log_perplexity"] <= r["high"]) for r in quality.judge(df).collect()]
    assert sum(not k for d, k, _ in got if d == "clean") <= 6
    for kind in junk:
        assert not any(k for d, k, _ in got if d == kind), kind
        assert not any(inside for d, _, inside in got if d == kind), kind


# 8
def brute_repeats(rows):
    """Rows are (rank, text), in rank order."""
    seen: set = set()
    for rank, text in rows:
        t = text or ""
        lines: list[list] = []
        for m in SPACED.finditer(t):
            if not lines or "\n" in t[lines[-1][-1].end() : m.start()]:
                lines.append([])
            lines[-1].append(m)
        units, whole = [], []
        for line in lines:
            parts, last, capital = [[line[0]]], 0, False
            capital = "A" <= line[0].group()[0] <= "Z" or "À" <= line[0].group()[0] <= "Þ"
            for i, (before, m) in enumerate(zip(line, line[1:], strict=False), 1):
                upper = "A" <= m.group()[0] <= "Z" or "À" <= m.group()[0] <= "Þ"
                if len(line) >= linededup.MIN_RUN and (before.group()[-1] in ".!?" or (upper and not capital)) and i - last >= linededup.MIN_UNIT:
                    parts.append([])
                    last = i
                parts[-1].append(m)
                capital = upper
            units += parts
            whole += [len(parts) == 1] * len(parts)
        flags = []
        for u in units:
            k = " ".join(m.group() for m in u).translate(LOW)
            flags.append(k in seen)
            seen.add(k)
        i = 0
        while i < len(units):
            j = i
            while j < len(units) and flags[j]:
                j += 1
            if sum(map(len, units[i:j])) < linededup.MIN_RUN:
                flags[i:j] = [bool(x) for x in whole[i:j]]
            i = max(j, i + 1)
        spans, i = [], 0
        while i < len(units):
            j = i
            while j < len(units) and flags[j]:
                j += 1
            if j > i:
                spans.append((units[i][0].start(), units[j][0].start() if j < len(units) else len(t)))
            i = max(j, i + 1)
        kept, at = "", 0
        for a, b in spans:
            kept += t[at:a]
            at = b
        yield rank, None if text is None else kept + t[at:], len(units), spans


def test_line_dedup(docs, none):
    got = linededup.remove_repeats(docs).collect()
    rows = sorted(corpus(), key=lambda r: (r[0] is None, r[0] or 0))
    same([(r["doc_id"], r["kept_text"], r["n_units"], [(s["start"], s["stop"]) for s in r["removed"]]) for r in got], brute_repeats([(r[0], r[1]) for r in rows]))
    assert sum(r["n_removed_words"] for r in got) > 100
    assert linededup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("from_words", [False, True])
def test_repeated_lines_go_whatever_their_length_and_what_stands_beside_them(spark, from_words):
    lines = ["share", "share this", "four words are enough", "this line of nine words is in both documents"]
    own = lambda i, k: prose(300 + 4 * i + k, 15).replace("\n", "")
    df = spark.createDataFrame([(i, "\n".join(x for k, line in enumerate(lines) for x in (own(i, k), line))) for i in range(3)], "doc_id bigint, text string")
    kept = {r["doc_id"]: r["kept_text"] for r in linededup.remove_repeats(df, from_words).collect()}
    assert [[line in kept[i].split("\n") for line in lines] for i in range(3)] == [[True] * 4, [False] * 4, [False] * 4]
    assert all(own(i, k) in kept[i] for i in range(3) for k in range(4))


def test_short_wordings_inside_lines_stay(spark):
    """Parts of long lines that come again by chance are no passages."""
    phrase = "once upon a time there was"
    rows = [(i, prose(800 + i, 30).replace("\n", "").replace(".", "") + f". {phrase.capitalize()}. " + prose(900 + i, 30).replace("\n", "")) for i in range(4)]
    for from_words in (False, True):
        got = linededup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), from_words).collect()
        assert all(r["kept_text"] == dict(rows)[r["doc_id"]] and not r["removed"] for r in got)


@pytest.mark.parametrize("syllables", [("the", "on", "er", "in"), ("αν", "το", "κα", "ρι"), ("ста", "но", "ва", "ли")])
def test_passages_without_marks_are_found_in_any_host(spark, syllables):
    def plain(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(3, 6))) for _ in range(n))

    sizes = {100 + i: 50 + i for i in range(51)}
    rows = [(d - 100, plain(d, 30 + d % 7) + " " + plain(5000 + d, n) + " " + plain(1000 + d, 40)) for d, n in sizes.items()]
    rows += [(d, plain(2000 + d, 20 + d % 11) + " " + plain(5000 + d, n) + " " + plain(3000 + d, 25)) for d, n in sizes.items()]
    rows += [(900 + i, plain(4000 + i, 80)) for i in range(20)]
    got = {r["doc_id"]: r["n_removed_words"] for r in linededup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), from_words=True).collect()}
    share = [got[d] / n for d, n in sizes.items()]
    assert min(share) > 0.5 and sum(share) / len(share) > 0.8 and max(share) <= 1
    assert not any(n for d, n in got.items() if d not in sizes)


# 9
def test_lm_scores(docs, none, vocabulary, monkeypatch):
    monkeypatch.setattr(lmscore, "BROADCAST_WORDS", 30)  # the others are joined
    got = lmscore.score(docs, vocabulary).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    counts, trained = collections.Counter(), 0
    for r in corpus():
        if not held(r[0]):
            counts.update(SPACED.findall((r[1] or "").translate(LOW)))
            trained += 1
    total, types = sum(counts.values()) + trained, len(counts) + 1
    want = []
    for r in corpus():
        w = SPACED.findall((r[1] or "").translate(LOW))
        cs = [counts[x] for x in w] + [trained]
        want.append((r[0], held(r[0]), len(cs), sum(c > 0 for c in cs), total, round(sum(math.log10((c + 0.5) / (total + 0.5 * (types + 1))) for c in cs), 6)))
    same([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got], want)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lmscore.score(none, vocabulary).count() == 0


def test_lattice_sums_all_segmentations():
    pieces = lmscore.Pieces((b" ", b" a", b"a", b"b", b"ab", b"ba", b"aba", b" ab"), np.log(np.array([0.1, 0.1, 0.2, 0.1, 0.1, 0.1, 0.05, 0.15, 0.1])))
    lattice = lmscore.Lattice(pieces)
    p = dict(zip(pieces.texts, np.exp(pieces.logp), strict=False))

    def all_of(word):
        if not word:
            yield ()
        for k in range(1, len(word) + 1):
            if word[:k] in p:
                yield from ((word[:k], *rest) for rest in all_of(word[k:]))

    for word in (b"a", b"ab", b"abab", b"babaab"):
        segmentations = list(all_of(b" " + word))
        weights = [math.prod(p[x] for x in s) for s in segmentations]
        expected = np.zeros(len(pieces.texts))
        data = np.frombuffer(word, np.uint8)
        got = lattice.words(data, np.array([0]), np.array([len(word)]), np.array([2.0]), expected)
        assert math.isclose(got[0], math.log(sum(weights)))
        for i, t in enumerate(pieces.texts):
            assert math.isclose(expected[i], 2 * sum(w * s.count(t) for w, s in zip(weights, segmentations, strict=True)) / sum(weights), abs_tol=1e-12)


def test_score_is_the_marginal_of_the_fitted_pieces(spark, docs, monkeypatch):
    """Expectation maximisation and the forward sum over all segmentations, in plain floats."""
    monkeypatch.setattr(lmscore, "LONG", 60)  # longer words go position by position
    texts = [" the", "the", "on", "er", " in", "in", "at", " at", "é", "tion", " tion", "x", "xxxx", " same", "same"]
    vocabulary = sentencepiece.Vocabulary(tuple((t, i, -1.0 - i / 7) for i, t in enumerate(texts)), (), 0)
    prior = lmscore.prior_pieces(vocabulary)
    logp = dict(zip(prior.texts, prior.logp.tolist(), strict=False))
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    words = lambda r: [(" " + w).encode() for w in SPACED.findall((r[1] or "").translate(LOW))]
    counts, trained = collections.Counter(), 0
    for r in corpus():
        if not held(r[0]):
            counts.update(words(r))
            trained += 1
    end = float(prior.logp[-1])
    longest = max(map(len, prior.texts))

    def add(x, y):
        return max(x, y) + math.log1p(math.exp(-abs(x - y))) if min(x, y) > -math.inf else max(x, y)

    def edges(word):
        return [(s, e, word[s:e]) for e in range(1, len(word) + 1) for s in range(max(0, e - longest), e) if word[s:e] in logp]

    def sums(word, found):
        alpha = [0.0] + [-math.inf] * len(word)
        for s, e, t in found:
            alpha[e] = add(alpha[e], alpha[s] + logp[t])
        return alpha

    before = -math.inf
    tokens = sum(counts.values()) + trained
    first = {t: math.exp(p) for t, p in logp.items()} | {None: math.exp(end)}
    for _ in range(lmscore.ROUNDS):
        n, reached = {t: lmscore.PRIOR * p for t, p in first.items()}, trained * end
        for word, c in counts.items():
            found = edges(word)
            alpha = sums(word, found)
            beta = [-math.inf] * len(word) + [0.0]
            for s, e, t in reversed(found):
                beta[s] = add(beta[s], beta[e] + logp[t])
            reached += c * alpha[-1]
            for s, e, t in found:
                n[t] += c * math.exp(alpha[s] + logp[t] + beta[e] - alpha[-1])
        n[None] += trained
        total = sum(n.values())
        end = math.log(n[None] / total)
        logp = {t: math.log(v / total) for t, v in n.items() if t is not None}
        if reached - before < lmscore.GAIN * tokens * math.log(10):
            break
        before = reached
    memo: dict = {}
    want = []
    for r in corpus():
        for w in words(r):
            if w not in memo:
                memo[w] = sums(w, edges(w))[-1]
        want.append((r[0], round((sum(memo[w] for w in words(r)) + end) / math.log(10), 4)))
    same([(r["doc_id"], round(r["score"], 4)) for r in lmscore.score(docs, vocabulary).collect()], want)


# 10
def brute_shared(rows):
    ids = lambda d: (d is None, d or 0)
    first: dict = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            k = b[i : i + 50]
            first[k] = min(first.get(k, ids(d)), ids(d))
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < ids(d):
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        yield d, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)


def test_suffix_dedup(docs, none):
    got = suffixdedup.remove_shared(docs).collect()
    same([(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), bytes(r["kept"])) for r in got], brute_shared([(r[0], r[1]) for r in corpus()]))
    assert suffixdedup.remove_shared(none).count() == 0


def test_equal_windows_are_found_whatever_the_depth():
    r = random.Random(3)
    base = bytes(r.choice(b"ab") for _ in range(400))
    data = np.frombuffer(base + b"q" + base[:200] + b"aaaa" * 60 + base[150:], np.uint8)
    start = np.arange(len(data) - suffixdedup.WIDTH + 1)
    order, new = suffixdedup.equal_windows(data, start)
    group = np.cumsum(new)
    got = collections.defaultdict(set)
    for i, g in zip(order.tolist(), group.tolist(), strict=True):
        got[g].add(i)
    want = collections.defaultdict(set)
    for i in start.tolist():
        want[data[i : i + 50].tobytes()].add(i)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_blind_tries_branch_where_the_plain_trie_does():
    """Nodes of the array trie against sets of windows: a node's members agree up to its depth and part there."""
    r = random.Random(11)
    words = [bytes(r.choice(b"ab") for _ in range(6)) * 9 for _ in range(12)]
    texts = [w[:50] for w in words for _ in range(r.randint(1, 3))] + [words[0][:40] + bytes(r.choice(b"xyz") for _ in range(10)) for _ in range(9)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    start = np.arange(len(texts)) * 50
    order, new = suffixdedup.multikey_quicksort(data, start, 16)
    assert [texts[i][:16] for i in order] == sorted(t[:16] for t in texts)
    assert new.tolist() == [k == 0 or texts[order[k]][:16] != texts[order[k - 1]][:16] for k in range(len(order))]
    trie = suffixdedup.blind_tries(data, start, order, new)
    assert [texts[i] for i in trie.order] == sorted(texts)
    ends = trie.first + trie.size
    for node in range(len(trie.first)):
        members = [texts[i] for i in trie.order[trie.first[node] : ends[node]]]
        depth = trie.depth[node]
        if depth < 0:
            assert len(set(members)) == 1
            continue
        assert len({m[:depth] for m in members}) == 1 and len({m[depth] for m in members}) > 1
        children = np.flatnonzero(trie.parent == node)
        assert sorted(trie.edge[children].tolist()) == sorted({m[depth] for m in members})
        assert sum(trie.size[children]) == len(members)
    leaves = trie.depth < 0
    assert sorted(collections.Counter(texts).values()) == sorted(trie.size[leaves].tolist())


def test_word_spans_and_hashes():
    texts = ["", "a b", " Ab  cd", "é x", "a b"]
    import pyarrow as pa

    data, off = X.text_bytes(pa.array(texts))
    w = X.words(data, off, X.table("spaced"))
    assert [bytes(data[a:b]).decode() for a, b in zip(w.start, w.end, strict=True)] == ["a", "b", "Ab", "cd", "é", "x", "a", "b"]
    assert w.counts.tolist() == [0, 2, 2, 2, 2]
    h = X.span_hash(X.prefix_codes(data), w.start, w.end)
    assert h[0] == h[6] and h[1] == h[7] and len(set(h.tolist())) == 6


def test_row_numbers_of_files_and_of_other_rows(spark, docs, tmp_path):
    by_file = common.with_numbers(docs)
    assert "monotonically_increasing_id" not in by_file._jdf.queryExecution().optimizedPlan().toString()
    assert by_file.select(common.ROW).distinct().count() == docs.count()
    for other in (docs.unionByName(docs), docs.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))).drop("x"), spark.createDataFrame(corpus(), DOCS)):
        numbered = common.with_numbers(other)
        assert numbered.select(common.ROW).distinct().count() == other.count()
    with common.intermediate(spark):
        with common.intermediate(spark):
            gone, kept = common.stored(docs, "gone"), common.returned(docs, "kept")
        assert kept.count() == docs.count()
        with pytest.raises(Exception, match="exist|FAILED_READ|cannot find"):
            gone.count()
    with pytest.raises(TypeError, match="integer"):
        linededup.remove_repeats(docs.withColumn("doc_id", F.col("doc_id").cast("string")))


def brute_phrases(text: bytes, known: bytes) -> int:
    at = n = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        at, n = max(at + 1, end - 1), n + 1
    return n


def fold(text: str) -> bytes:
    return re.sub(rb"[^a-z\x80-\xff]+", b" ", text.translate(LOW).encode()).lstrip(b" ")


def test_language_id_is_a_plain_cross_parse_of_whole_texts(spark, docs):
    refs = [langid.Reference("p", fold(prose(900, 60)), 3.0), langid.Reference("q", fold(prose(901, 60, ("ñu", "ció", "que", "os"))), 3.0)]
    got = langid.tagged(docs.select("doc_id", "text"), refs).collect()
    assert len(got) == len(corpus())
    for r in got:
        t = fold(r["text"] or "")
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["bits"], r["foreign"]) == ("und", 0.0, 0.0, False)
            continue
        bits = [brute_phrases(t, x.text) * math.log2(len(x.text)) / max(1, len(t)) for x in refs]
        assert math.isclose(r["bits"], min(bits)) and r["lang_pred"] == refs[bits.index(min(bits))].lang
        weights = [1 / max(b, 1e-9) ** 8 for b in bits]
        assert math.isclose(r["score"], max(weights) / sum(weights))
        assert r["foreign"] == (min(bits) * len(t) > langid.FOREIGN * 3.0 * len(t) + langid.SLACK)


def test_no_language_is_left_out(spark):
    tongues = {f"l{k:03d}": tuple(chr(0x400 + (7 * k + j) % 900) + chr(0x400 + (13 * k + 5 * j) % 900) for j in range(5)) for k in range(230)}
    rows = [(i, prose(i, 12, s), name) for i, (name, s) in enumerate(list(tongues.items()) * 4)]
    rows += [(None, "the same text in every row", "en")] * 300
    refs = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert {r.lang for r in refs} == {*tongues, "en"} and sum(len(r.text.decode(errors="replace")) for r in refs) <= langid.SAMPLE + 10 * len(refs)


# the pipeline
def test_pipeline_is_its_stages_one_after_another(spark, tmp_path):
    """Against plain Python for verdicts, with rows that repeat, nulls and extra columns."""
    tongues = {"aa": ("the", "ing", "er", "an"), "bb": ("ñu", "ció", "que", "os")}
    texts = [(i, prose(7000 + i, 90, tongues["aa" if i % 2 else "bb"]), "aa" if i % 2 else "bb") for i in range(60)]
    texts += [(100, texts[3][1] + " more", "aa"), (101, texts[4][1], "bb"), (101, texts[4][1], "bb"), (None, texts[5][1], "aa"), (102, None, "aa"), (103, "", None), (104, "123 !!", None), (105, prose(42, 200, ("дж", "щэ", "ёх")), None)]
    texts += [(106, prose(8000, 20, tongues["aa"]) + " " + " ".join(prose(1, 120).split(" ")[10:40]), "aa"), (107, prose(8001, 40, tongues["aa"]) + "\n" + texts[7][1], "aa"), (108, None, None)]
    docs = [(d, t, lang, "s", None if t is None else len(t), "clash") for d, t, lang in texts]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string"
    spark.createDataFrame(docs, kind).repartition(3).write.parquet(f"file:{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t, _ in BENCH], "item_id bigint, text string").write.parquet(f"file:{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"file:{tmp_path}").collect()

    # language ID: no letters, or a language that wasn't learned
    rows = [r for r in docs if r[0] not in (102, 103, 104, 105, 108)]
    # near duplicates: the least doc_id of each component, nulls last, the first of equal rows
    seen, kept = set(), []
    parts = {}
    sets = [shingle_set(r[1]) for r in rows]
    for i in range(len(rows)):
        parts[i] = i
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = parts[i], parts[j]
                parts = {k: b if v == a else v for k, v in parts.items()}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        if parts[i] not in seen:
            seen.add(parts[i])
            kept.append(rows[i])
    # substring dedup, by the operator that has its own test; then contaminated ones go
    frame = spark.createDataFrame(kept, kind)
    cut = [(r["doc_id"], r["kept_text"], r["n_removed_units"]) for r in linededup.remove_repeats(frame, from_words=True).collect()]
    assert any(n for d, _, n in cut if d == 107)
    dirty = {r[0] for r in brute_contamination([(d, t) for d, t, _ in cut], BENCH) if r[5]}
    assert 106 in dirty
    want = {d: t for d, t, _ in cut if d not in dirty}
    assert {r["doc_id"] for r in got} == set(want) and len(got) == len(want)
    pieces = sentencepiece.load_vocabulary()
    ids = {r["doc_id"]: r["ids"] for r in sentencepiece.encode(spark.createDataFrame(list(want.items()), "doc_id bigint, text string"), pieces).collect()}
    assert all(r["round_trip"] and r["ids"] == ids[r["doc_id"]] and r["n_ids"] == len(r["ids"]) for r in got)
    empty = spark.createDataFrame([], kind)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, f"file:{tmp_path}")
        assert out.columns == empty.columns and out.count() == 0, name
    assert corpus_pipeline.encoding(spark, empty, "").count() == 0
