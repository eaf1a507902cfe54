"""Validation and routing of event envelopes, derived events and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DoubleType, FloatType, StringType, StructField, StructType

from ..functions.identity import canonical_json, event_id, iso_ms, truncate_ms
from ..functions.schemas import IMBALANCE, LOAD, OUTCOMES, PREDICTIONS, SNAPSHOTS, SOLAR, WIND

SUPPORTED_SCHEMA = "1"
# Fixed names of event types, each with its table.
EVENT_TABLES = {
    "elia.imbalance.observed": "imbalance_observations",
    "elia.load.observed": "load_observations",
    "elia.wind.observed": "wind_observations",
    "elia.solar.observed": "solar_observations",
    "imbalance.features.generated": "feature_snapshots",
    "imbalance.prediction.generated": "predictions",
    "imbalance.prediction.evaluated": "prediction_outcomes",
}
_OBSERVED = {"elia.imbalance.observed": IMBALANCE, "elia.load.observed": LOAD, "elia.wind.observed": WIND, "elia.solar.observed": SOLAR}
_OWN = {"event_id", "ingested_at", "row_version", "created_at"}


def payload_schema(event_type: str) -> StructType:
    full = {**_OBSERVED, "imbalance.features.generated": SNAPSHOTS, "imbalance.prediction.generated": PREDICTIONS, "imbalance.prediction.evaluated": OUTCOMES}[event_type]
    wide = lambda t: DoubleType() if isinstance(t, FloatType) else ArrayType(DoubleType()) if isinstance(t, ArrayType) and not isinstance(t.elementType, ByteType) else t
    return StructType([*(StructField(f.name, wide(f.dataType)) for f in full if f.name not in _OWN), StructField("_corrupt", StringType())])


def vector_problem(values: Column, masks: Column) -> Column:
    """True unless values and masks are equally long, masks 0 or 1, and values finite."""
    fine = (F.size(values) == F.size(masks)) & F.forall(masks, lambda m: m.isin(0, 1)) & F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return ~F.coalesce(fine, F.lit(False))


def _problem(event_type: str, p: str) -> Column:
    """True if the parsed payload ``p`` breaks a rule of its type."""
    c = lambda name: F.col(f"{p}.{name}")
    bad = F.col(p).isNull() | c("_corrupt").isNotNull()
    number = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    if event_type in _OBSERVED:
        bad = bad | ~c("timestamp").eqNullSafe(F.col("event_time"))
        for f in _OBSERVED[event_type]:
            if isinstance(f.dataType, DoubleType):
                bad = bad | F.coalesce(F.isnan(c(f.name)), F.lit(False))
        need = {"elia.imbalance.observed": ("resolution_code", "quality_status", "quarter_hour"), "elia.wind.observed": ("offshore_onshore", "region", "grid_connection_type"), "elia.solar.observed": ("region",)}.get(event_type, ())
        for name in need:
            bad = bad | c(name).isNull()
        if event_type == "elia.imbalance.observed":
            bad = bad | number(c("system_imbalance_mw")) | ~c("quality_status").eqNullSafe(F.col("quality_status"))
    elif event_type == "imbalance.features.generated":
        for kind in ("local", "context", "static"):
            bad = bad | vector_problem(c(f"{kind}_values"), c(f"{kind}_masks"))
        bad = bad | c("cutoff").isNull() | (F.unix_seconds(c("target_time")) != F.unix_seconds(c("cutoff")) + 60)
    elif event_type == "imbalance.prediction.generated":
        for name in ("system_imbalance_mw", "p10_mw", "p90_mw", "flip_probability"):
            bad = bad | number(c(name))
        bad = bad | (c("p10_mw") > c("p90_mw")) | ~c("flip_probability").between(0, 1)
        for name in ("cutoff", "target_time", "generated_at", "will_flip", "prediction_quality", "model_version", "feature_schema_hash"):
            bad = bad | c(name).isNull()
    else:
        bad = bad | number(c("realized_system_imbalance_mw"))
        for name in ("prediction_event_id", "target_time", "realized_event_id", "evaluated_at"):
            bad = bad | c(name).isNull()
    return F.coalesce(bad, F.lit(True))


def route(envelopes: DataFrame) -> DataFrame:
    """Add ``reason``: null, unsupported_schema_version, unsupported_event_type or invalid_payload; and the parsed payload of its type.

    A payload is parsed once: it comes out of a generator, below which filters on the reason aren't pushed.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "true"}
    parsed = F.struct(*[F.when(F.col("event_type") == t, F.from_json("payload", payload_schema(t), options)).alias(f"p{i}") for i, t in enumerate(EVENT_TABLES)])
    out = envelopes.withColumn("__parsed", F.explode(F.array(parsed))).select(*envelopes.columns, "__parsed.*")
    reason = F.when(F.coalesce(F.col("schema_version") != SUPPORTED_SCHEMA, F.lit(True)), "unsupported_schema_version").when(~F.coalesce(F.col("event_type").isin(*EVENT_TABLES), F.lit(False)), "unsupported_event_type")
    for i, t in enumerate(EVENT_TABLES):
        reason = reason.when((F.col("event_type") == t) & _problem(t, f"p{i}"), "invalid_payload")
    return out.withColumn("reason", reason)


def typed_rows(routed: DataFrame, event_type: str) -> DataFrame:
    """Valid rows of a type with their payload's fields, identity and time of ingestion."""
    i = list(EVENT_TABLES).index(event_type)
    fields = [f.name for f in payload_schema(event_type) if f.name != "_corrupt"]
    rows = routed.where((F.col("event_type") == event_type) & F.col("reason").isNull())
    return rows.select("event_id", "ingested_at", *[F.col(f"p{i}.{f}").alias(f) for f in fields])


def ingest_counters(routed: DataFrame) -> DataFrame:
    return routed.groupBy("source", "dataset").agg(F.count_if(F.col("reason").isNull()).alias("published"), F.count("reason").alias("errors"))


def eligible_snapshot(observed: Column, current: Column, age: Column, min_observed: int = 30, max_age: float = 5.0) -> Column:
    return F.coalesce((observed >= min_observed) & current.isNotNull() & (age <= max_age), F.lit(False))


def snapshot_semantics(cutoff: Column, target: Column, eligible: Column, current: Column, step_seconds: int = 60) -> Column:
    """The target is the next step, and an eligible snapshot knows its state."""
    return (F.unix_seconds(target) == F.unix_seconds(cutoff) + step_seconds) & (~eligible | current.isNotNull())


def _derived(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[c.alias(k) for k, c in columns.items()])


def stored_triggers(rows: DataFrame, kind: str = "stored-elia-imbalance", event_type: str = "elia.imbalance.stored") -> DataFrame:
    """The event that tells of a stored row; its id follows from the source's id and millisecond of ingestion."""
    at = truncate_ms("ingested_at")
    return _derived(
        rows, event_id=event_id(F.lit("clickhouse"), F.lit(kind), F.concat_ws(":", "event_id", iso_ms(at)), F.lit("1")), event_type=F.lit(event_type), event_time=F.col("event_time"),
        ingested_at=at, causation_id=F.col("event_id"), payload=canonical_json(source_event_id=F.col("event_id"), timestamp=iso_ms("event_time"), source_ingested_at=iso_ms(at)),
    )


def prediction_events(rows: DataFrame) -> DataFrame:
    """One event for each trigger, model and feature schema."""
    key = F.concat_ws(":", "trigger_id", "model_version", "feature_schema_hash")
    fields = [f.name for f in PREDICTIONS if f.name not in ("event_id", "row_version")]
    return _derived(rows, event_id=event_id(F.lit("predictor"), F.lit("system-imbalance"), key, F.lit("1")), event_type=F.lit("imbalance.prediction.generated"), causation_id=F.col("trigger_id"), event_time=F.col("target_time"), ingested_at=F.col("generated_at"), payload=canonical_json(*fields))


def feature_events(rows: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "trigger_id", "feature_schema_hash")
    return _derived(rows, event_id=event_id(F.lit("features"), F.lit("system-imbalance"), key, F.lit("1")), event_type=F.lit("imbalance.features.generated"), causation_id=F.col("trigger_id"), event_time=F.col("cutoff"), ingested_at=F.col("created_at"))


def outcome_events(rows: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "prediction_event_id", "realized_event_id", iso_ms("evaluated_at"))
    fields = [f.name for f in OUTCOMES if f.name != "row_version"]
    return _derived(rows, event_id=event_id(F.lit("outcome-joiner"), F.lit("prediction-outcome"), key, F.lit("1")), event_type=F.lit("imbalance.prediction.evaluated"), causation_id=F.col("prediction_event_id"), event_time=F.col("target_time"), ingested_at=F.col("evaluated_at"), payload=canonical_json(*fields))


