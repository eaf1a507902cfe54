"""Views of the given tables as versioned observations, predictions, outcomes and scored rows; each in Spark and in SQL.

``events`` are revisions of two-hour steps: the event type is the series, the event's time is when its value became known.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import row_version, truncate_ms
from ..functions.scalars import floor_steps, shift, state_name
from ..functions.schemas import Registry
from ..operators.windows import sign_of

STEP = 7200
DEADBAND = 10.0
KNOWN = "2024-01-20 00:00:00"
#: Windows of the tests' layout, in two-hour steps.
REGISTRY = Registry(step_seconds=STEP, local_steps=24, bin_steps=3, bins=12, min_observed=5, max_age=5)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    v, u = F.col("value"), F.col("user_id")
    return e.select(
        F.col("event_type").alias("series"), floor_steps(F.col("ts"), STEP).alias("timestamp"), truncate_ms("ts").alias("ingested_at"), F.col("event_id").cast("string").alias("event_id"),
        (v - 35).alias("system_imbalance_mw"), F.when(u % 4 != 0, v * 0.5).alias("ace_mw"), F.when(u % 5 != 0, v * 2).alias("imbalance_price_eur_mwh"), F.lit(None).cast("double").alias("marginal_incremental_price_eur_mwh"),
        (v + 1).alias("marginal_decremental_price_eur_mwh"), F.when(u % 3 == 0, "Validated").when(u % 3 == 1, "VALIDATED").otherwise("DataIssue").alias("quality_status"), u.alias("user_id"),
        row_version(truncate_ms("ts"), F.col("event_id").cast("string")).alias("row_version"),
    )


OBS = f"""obs AS (SELECT event_type AS series, make_timestamp((epoch_us(ts) // {STEP}000000) * {STEP}000000) AS t, date_trunc('milliseconds', ts) AS ingested_at, CAST(event_id AS VARCHAR) AS event_id,
 value - 35 AS v, CASE WHEN user_id % 4 <> 0 THEN value * 0.5 END AS ace, CASE WHEN user_id % 5 <> 0 THEN value * 2 END AS price, value + 1 AS dec_price,
 CASE user_id % 3 WHEN 0 THEN 'Validated' WHEN 1 THEN 'VALIDATED' ELSE 'DataIssue' END AS quality, user_id,
 (epoch_us(ts) // 1000) * 1048576 + CAST('0x' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 5) AS BIGINT) AS rv FROM events)"""
CAN = """can AS (SELECT series, t, r.v AS v, r.q AS quality, r.ace AS ace, r.price AS price, r.dec_price AS dec_price, r.ingested_at AS ingested_at, r.event_id AS event_id, r.rv AS rv
 FROM (SELECT series, t, arg_max({'v': v, 'q': quality, 'ace': ace, 'price': price, 'dec_price': dec_price, 'ingested_at': ingested_at, 'event_id': event_id, 'rv': rv}, {'a': rv, 'b': ingested_at, 'c': event_id}) AS r FROM obs %s GROUP BY series, t))"""
GRID = f"""grid AS (SELECT g.series, g.t, c.v, c.quality, c.ace, c.price, c.dec_price FROM
 (SELECT series, unnest(generate_series(lo, hi, INTERVAL {STEP} SECOND)) AS t FROM (SELECT series, min(t) AS lo, max(t) AS hi FROM can GROUP BY series)) g LEFT JOIN can c ON c.series = g.series AND c.t = g.t)"""


def canonical_sql(known: str | None = None) -> str:
    return f"WITH {OBS}, {CAN % (f'WHERE ingested_at <= TIMESTAMP {known!r}' if known else '')}"


def grid_sql(known: str | None = None) -> str:
    return f"{canonical_sql(known)}, {GRID}"


def ms(c, name: str):
    return F.unix_millis(c if not isinstance(c, str) else F.col(c)).alias(name)


def r4(c, name: str):
    """Rounded to four digits, without a negative zero."""
    return (F.round(c if not isinstance(c, str) else F.col(c), 4) + 0.0).alias(name)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Each observation forecasts the next step: itself, with a band.  Users share ids, so predictions have revisions."""
    o = observations(spark, sf)
    v = F.col("system_imbalance_mw")
    p = ((F.col("user_id") * 7) % 101) / 100.0
    state = state_name(sign_of(v, DEADBAND))
    return o.select(
        F.concat_ws("|", "series", (F.unix_seconds("timestamp")).cast("string"), (F.col("user_id") % 3).cast("string")).alias("event_id"), "series", F.col("timestamp").alias("cutoff"), shift(F.col("timestamp"), STEP).alias("target_time"),
        F.col("ingested_at").alias("generated_at"), v.alias("system_imbalance_mw"), (v - 20).alias("p10_mw"), (v + 20).alias("p90_mw"), p.alias("flip_probability"), (p >= 0.5).alias("will_flip"), state.alias("current_state"),
        F.when((p >= 0.5) & state.isNotNull(), F.when(state == "positive", "negative").otherwise("positive")).otherwise(state).alias("predicted_state"), F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model_version"), "row_version",
    )


PRED = f"""{OBS}, pred AS (SELECT series || '|' || CAST(epoch_ms(t) // 1000 AS VARCHAR) || '|' || CAST(user_id % 3 AS VARCHAR) AS event_id, series, t AS cutoff, t + INTERVAL {STEP} SECOND AS target_time, ingested_at AS generated_at, v, v - 20 AS p10, v + 20 AS p90,
 ((user_id * 7) % 101) / 100.0 AS p, CASE WHEN v > 10 THEN 'positive' WHEN v < -10 THEN 'negative' END AS cs, 'm' || CAST(user_id % 3 AS VARCHAR) AS model_version, rv FROM obs),
predc AS (SELECT event_id, r.* FROM (SELECT event_id, arg_max({{'series': series, 'target_time': target_time, 'generated_at': generated_at, 'v': v, 'p10': p10, 'p90': p90, 'p': p, 'cs': cs, 'rv': rv, 'model_version': model_version}}, {{'a': rv, 'b': generated_at}}) AS r FROM pred GROUP BY event_id))"""


def realised(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.pit import canonical_latest

    c = canonical_latest(observations(spark, sf))
    return c.select("series", "timestamp", F.col("event_id").alias("realized_event_id"), F.col("system_imbalance_mw").alias("realized_value"), F.col("ingested_at").alias("available_at"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with forecast, band, flip probability and label for three models, made from each event."""
    e = events(spark, sf)
    v, i, u = F.col("value") - 35, F.col("event_id"), F.col("user_id")
    variants = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(a).alias("a"), F.lit(s).cast("bigint").alias("s"), F.lit(w).alias("w")) for n, a, s, w in (("candidate", 0.9, 3, 40.0), ("classical", 0.7, 5, 30.0), ("persistence", 0.5, 7, 20.0))])
    x = e.withColumn("m", F.explode(variants))
    pred = v * F.col("m.a") + 2
    return x.select(
        F.col("m.model").alias("model"), i.alias("row_id"), F.col("ts").alias("cutoff"), v.alias("actual"), pred.alias("predicted"), (pred - F.col("m.w")).alias("p10"), (pred + F.col("m.w")).alias("p90"),
        ((i * 31 + u) % 3 == 0).cast("int").alias("flip_target"), (((i * F.col("m.s") + u * 11) % 997) / 996.0).alias("flip_probability"), (i % 5 != 0).cast("int").alias("flip_mask"),
        F.when(v > 10, "positive").when(v < -10, "negative").alias("current_state"), ((u % 3).cast("int") - 1).alias("quality_code"), (F.abs(v) + (u % 7)).alias("volatility"),
    )


SCORED = """scored AS (SELECT m.model AS model, event_id AS row_id, ts AS cutoff, value - 35 AS actual, (value - 35) * m.a + 2 AS predicted, (value - 35) * m.a + 2 - m.w AS p10, (value - 35) * m.a + 2 + m.w AS p90,
 CASE WHEN (event_id * 31 + user_id) % 3 = 0 THEN 1 ELSE 0 END AS t, ((event_id * m.s + user_id * 11) % 997) / 996.0 AS p, CASE WHEN event_id % 5 <> 0 THEN 1 ELSE 0 END AS k,
 CASE WHEN value - 35 > 10 THEN 'positive' WHEN value - 35 < -10 THEN 'negative' END AS cs, user_id % 3 - 1 AS quality_code, abs(value - 35) + user_id % 7 AS volatility
 FROM events CROSS JOIN (VALUES ('candidate', CAST(0.9 AS DOUBLE), 3, CAST(40 AS DOUBLE)), ('classical', CAST(0.7 AS DOUBLE), 5, CAST(30 AS DOUBLE)), ('persistence', CAST(0.5 AS DOUBLE), 7, CAST(20 AS DOUBLE))) AS m(model, a, s, w))"""
