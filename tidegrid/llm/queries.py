"""Registered queries of the text operators and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import format_preferences, preference_pairs
from .decontamination import decontaminate
from .jaccard import near_duplicates
from .langid import fit, identify
from .linededup import remove_repeats
from .lmscore import score
from .quality import judge
from .repair import damaged, repair
from .resampling import resample
from .sentencepiece import encode, load_vocabulary
from .sharding import shuffle_into_shards
from .suffixdedup import remove_shared
from .warc import read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dw.n, i, item FROM dw JOIN win ON dw.n = win.n AND dw.t = win.t),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = load_vocabulary()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, vocabulary, decoded="decoded")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op3_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_preferences(preference_pairs(_table(spark, sf_dir, "conversations")))
    runs = lambda c: F.array_join(F.transform(c, lambda r: F.concat(r["chars"].cast("string"), F.when(r["loss"], "+").otherwise("-"))), "")
    return out.select("conv_id", "prompt_turns", "prompt", "chosen", "rejected", runs("chosen_runs").alias("chosen_mask"), runs("rejected_runs").alias("rejected_mask"))


_RENDER = "list_transform({0}, lambda t: '<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10))"
_RUNS = "list_transform({0}, lambda t: CAST(length('<|' || coalesce(t.role, '') || '|>' || chr(10)) AS VARCHAR) || '-' || CAST(length(coalesce(t.text, '') || '<|end|>' || chr(10)) AS VARCHAR) || CASE WHEN t.role = 'assistant' THEN '+' ELSE '-' END)"
_JOIN = "coalesce(array_to_string({0}, ''), '')"

OP3_SQL = f"""
WITH c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
said AS (SELECT conv_id, own, list_filter(own, lambda x: x.role = 'assistant') AS answers,
         list_max(list_transform(range(1, len(own) + 1), lambda i: CASE WHEN own[i].role = 'assistant' THEN i END)) AS last FROM c),
cut AS (SELECT conv_id, answers, last, CASE WHEN last IS NULL THEN own ELSE own[1:last] END AS chosen FROM said),
pair AS (SELECT a.conv_id, a.chosen, CASE WHEN a.last IS NULL THEN a.chosen
         WHEN b.answers IS NULL OR len(b.answers) = 0 THEN a.chosen[1:a.last - 1]
         ELSE list_append(a.chosen[1:a.last - 1], {{'role': 'assistant', 'text': b.answers[len(b.answers)].text}}) END AS rejected
         FROM cut a LEFT JOIN cut b ON b.conv_id = xor(a.conv_id, 1)),
pre AS (SELECT *, coalesce(list_min(list_transform(range(1, greatest(len(chosen), len(rejected)) + 1), lambda i: CASE WHEN i > len(chosen) OR i > len(rejected) OR chosen[i].role IS DISTINCT FROM rejected[i].role OR chosen[i].text IS DISTINCT FROM rejected[i].text THEN i - 1 END)), len(chosen)) AS n FROM pair)
SELECT conv_id, CAST(n AS INTEGER) AS prompt_turns, {_JOIN.format(_RENDER.format("chosen[1:n]"))} AS prompt,
       {_JOIN.format(_RENDER.format("chosen[n + 1:]"))} AS chosen, {_JOIN.format(_RENDER.format("rejected[n + 1:]"))} AS rejected,
       {_JOIN.format(_RUNS.format("chosen[n + 1:]"))} AS chosen_mask, {_JOIN.format(_RUNS.format("rejected[n + 1:]"))} AS rejected_mask
FROM pre
"""


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(spark, write_warc(_table(spark, sf_dir, "pages")))
    return records.select(F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


OP5_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


_SPACED = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP6_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(doc_id, there) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.there)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(there) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("log_perplexity", 6).alias("log_perplexity"), "model")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), from_words=True)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"), load_vocabulary()).drop("uid")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_shared(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS k FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
f AS (SELECT k, min(doc_id) AS least FROM w GROUP BY k),
c AS (SELECT r, i FROM w JOIN f USING (k) WHERE doc_id > least),
n AS (SELECT r, i, coalesce(CAST(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50 AS INTEGER), 1) AS new FROM c),
g AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM n),
s AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY r, g),
t AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS pb FROM s),
p AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substr(h, 2 * pb + 1, 2 * (a - pb)), '' ORDER BY a) AS kept, max(b) AS last FROM t JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN unhex(h) ELSE unhex(kept || substr(h, 2 * last + 1)) END) AS kept_sha256
FROM d LEFT JOIN p USING (r)
"""


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    found = repair(damaged(rows))
    every = rows.select("conv_id").distinct().withColumnRenamed("conv_id", "c")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return every.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("c").alias("conv_id"), *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


#: CRC-32 of the distinct strings of a table ``{0}`` (s): each byte's part in the register, for the bytes that follow it.
_CRC = """step(k, b, v) AS (SELECT 0, b, b FROM range(256) AS r(b) UNION ALL SELECT k + 1, b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8),
own AS (SELECT s, encode(s) AS e, octet_length(encode(s)) AS n FROM {0}),
far(k, b, v) AS (SELECT 0, b, v FROM step WHERE k = 8 UNION ALL SELECT f.k + 1, f.b, xor(f.v >> 8, t.v) FROM far f JOIN step t ON t.k = 8 AND t.b = f.v & 255 WHERE f.k + 1 < (SELECT max(n) FROM own)),
bytes AS (SELECT s, n, i, xor(CAST('0x' || substr(hex(e), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT), CASE WHEN i < 4 THEN 255 ELSE 0 END) AS b FROM (SELECT s, e, n, unnest(range(n)) AS i FROM own)),
crc AS (SELECT s, xor(xor(bit_xor(f.v), CASE WHEN any_value(n) < 4 THEN 4294967295 >> (8 * any_value(n)) ELSE 0 END), 4294967295) AS crc FROM bytes JOIN far f ON f.k = n - 1 - i AND f.b = bytes.b GROUP BY s)"""

_FAR_COST = 1_000_000_000
_STATES = ((2, "u", "user"), (2, "u", "user"), (3, "a", "assistant"), (2, "u", "user"))


def _step_sql() -> str:
    """The best (cost, audit, lines) of each state after one more row, from those before it, and after inserts."""
    item = lambda c, a, x: f"{{'c': {c}, 'a': {a}, 'x': {x}}}"
    least = lambda *xs: f"list_min([{', '.join(xs)}])"
    line = lambda s, text: f"list_append({s}.x, {text})"
    insert = lambda s, k: item(f"{s}.c + 5", f"{s}.a || 'I'", line(s, f"'{_STATES[k][2]}:'"))
    stay = "CASE WHEN r.fault = 2 THEN 1000000000 WHEN r.fault = 1 THEN 5 ELSE 0 END"
    to: dict[int, list[str]] = {k: [item(f"s{k}.c + 2", f"s{k}.a || 'D'", f"s{k}.x")] for k in range(4)}
    keep = lambda k, ok: item(f"s{k}.c + CASE WHEN {ok} THEN {stay} ELSE 1000000000 END", f"s{k}.a || 'K'", line(f"s{k}", "r.role || ':' || r.text"))
    to[1].append(keep(0, "r.initial = 's'"))
    for k, (after, initial, role) in enumerate(_STATES):
        to[after] += [keep(k, f"r.initial = '{initial}'"), item(f"s{k}.c + 1 + {stay}", f"s{k}.a || 'R'", line(f"s{k}", f"'{role}:' || r.text"))]
    rows = "SELECT t.conv, r.i, " + ", ".join(f"{least(*to[k])} AS q{k}" for k in range(4)) + " FROM t JOIN r ON r.conv IS NOT DISTINCT FROM t.conv AND r.i = t.i + 1"
    two = f"SELECT conv, i, q0, q1, q3, {least('q2', insert('q0', 0), insert('q1', 1), insert('q3', 3))} AS p2 FROM ({rows})"
    return f"SELECT conv, i, q0, q1, p2, {least('q3', insert('p2', 2))} FROM ({two})"


_START = ", ".join(f"{{'c': {c}, 'a': '{a}', 'x': CAST([{x}] AS VARCHAR[])}}" for c, a, x in ((0, "", ""), (_FAR_COST, "", ""), (5, "I", "'user:'"), (10, "II", "'user:', 'assistant:'")))

OP11_SQL = f"""
WITH RECURSIVE raw AS (SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
keys AS (SELECT DISTINCT key AS s FROM raw), {_CRC.format("keys")},
dam AS (SELECT conv, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role, CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN crc % 20 = 3 THEN 2 ELSE 1 END)) AS copy
        FROM raw JOIN crc ON s = key WHERE crc % 20 <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i, regexp_extract_all(text, '[^\x20\x09-\x0D]') AS seen FROM dam),
told AS (SELECT *, len(seen) = 0 AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again, len(seen) > 0 AND seen[-1] NOT IN ('.', '!', '?') AS cut, substr(role, 1, 1) AS initial FROM num),
r AS (SELECT conv, i, turn, role, text, initial, CASE WHEN blank OR again THEN 2 WHEN cut THEN 1 ELSE 0 END AS fault, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND cut AS truncated,
      lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM told),
t(conv, i, s0, s1, s2, s3) AS (SELECT DISTINCT conv, 0, {_START} FROM raw UNION ALL {_step_sql()}),
last AS (SELECT conv, list_min([s0, s3]) AS best FROM t QUALIFY row_number() OVER (PARTITION BY conv ORDER BY i DESC) = 1),
agg AS (SELECT conv, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv)
SELECT last.conv AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(coalesce(array_to_string(best.x, chr(10)), '')) AS repaired_sha256
FROM last LEFT JOIN agg ON agg.conv IS NOT DISTINCT FROM last.conv
"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP12_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
df AS (SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS s FROM d),
bf AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS s FROM b),
every AS (SELECT DISTINCT s FROM (SELECT s FROM df UNION ALL SELECT s FROM bf)), {_CRC.format("every")},
sn AS (SELECT crc % 10000 AS k, count(*) AS s FROM df JOIN crc USING (s) GROUP BY 1), tn AS (SELECT crc % 10000 AS k, count(*) AS t FROM bf JOIN crc USING (s) GROUP BY 1),
tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM sn) AS s, (SELECT coalesce(sum(t), 0) FROM tn) AS t),
g AS (SELECT sn.k, CAST(floor(1000 * ln((coalesce(tn.t, 0) + 1.0::DOUBLE) * (tot.s + 10000.0::DOUBLE) / ((sn.s + 1.0::DOUBLE) * (tot.t + 10000.0::DOUBLE)))) AS BIGINT) AS g FROM sn LEFT JOIN tn USING (k), tot),
w AS (SELECT r, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight FROM df JOIN crc USING (s) JOIN g ON g.k = crc % 10000 GROUP BY r),
a AS (SELECT doc_id, len(w) AS words, CAST(greatest(0, 2 * len(w) - 1) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN w USING (r)),
o AS (SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place, count(*) FILTER (words >= 20) OVER () AS n FROM a)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM o
"""


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("row.text").cast("string")
    return shuffle_into_shards(_table(spark, sf_dir, "documents"), 24).select(
        F.col("row.doc_id").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def sharding_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op13's shards: rows and slots of each."""
    return op13_sharding(spark, sf_dir).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count_distinct("slot").alias("slots"))


SHARDING_LAWS_SQL = """
WITH n AS (SELECT count(*) AS n FROM documents), s AS (SELECT CAST(s AS INTEGER) AS shard, (s + 1) * n // 24 - s * n // 24 AS n FROM n, range(24) AS r(s))
SELECT shard, n, CAST(0 AS BIGINT) AS lo, n - 1 AS hi, n AS slots FROM s WHERE n > 0
"""


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7 that SQL can express."""
    return op7_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUALITY_BASE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_SPACED.format("coalesce(text, '')")} AS w FROM documents),
ln AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM (SELECT doc_id, i, hash(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY 1),
a AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a
"""


def lm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9 that SQL can express."""
    return op9_lm_score(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", (F.round("base_score", 3) + 0.0).alias("base_score"))


LM_BASE_SQL = f"""
WITH RECURSIVE keys AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL), {_CRC.format("keys")},
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(crc % 5 = 1, false) AS held_out, list_append({_SPACED.format(_LOWER.format("coalesce(text, '')"))}, '') AS w FROM documents LEFT JOIN crc ON s = CAST(doc_id AS VARCHAR)),
t AS (SELECT r, unnest(w) AS tok FROM d),
c AS (SELECT tok, count(*) AS c FROM t JOIN d USING (r) WHERE NOT held_out GROUP BY tok),
n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT any_value(doc_id) AS doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(c) AS n_known, CAST(any_value(n.n) AS BIGINT) AS train_tokens,
       round(sum(log10((coalesce(c, 0) + 0.5::DOUBLE) / (n.n + 0.5::DOUBLE * (n.v + 1)))), 3) + 0.0 AS base_score
FROM t JOIN d USING (r) LEFT JOIN c USING (tok), n GROUP BY r
"""


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_chat_preferences": op3_chat_preferences,
    "op4_language_id": op4_language_id,
    "op5_warc": op5_warc,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_sharding": op13_sharding,
    "lm_base": lm_base,
    "quality_base": quality_base,
    "sharding_laws": sharding_laws,
}
ORACLES = {"op1_decontamination": OP1_SQL, "op3_chat_preferences": OP3_SQL, "op5_warc": OP5_SQL, "op6_ngram_jaccard": OP6_SQL, "op10_suffix_dedup": OP10_SQL, "op11_conversation_repair": OP11_SQL, "op12_importance_resampling": OP12_SQL, "lm_base": LM_BASE_SQL, "quality_base": QUALITY_BASE_SQL, "sharding_laws": SHARDING_LAWS_SQL}
