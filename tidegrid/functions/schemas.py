"""Explicit schemas of the typed tables and the feature registry with its fingerprint."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql.types import ArrayType, BooleanType, ByteType, DoubleType, FloatType, LongType, StringType, StructField, StructType, TimestampType

from . import contract

_S, _T, _D, _L = StringType(), TimestampType(), DoubleType(), LongType()


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


ENVELOPE = _struct(
    event_id=_S, event_type=_S, schema_version=_S, source=_S, dataset=_S, event_time=_T, observed_at=_T, ingested_at=_T,
    correlation_id=_S, causation_id=_S, quality_status=_S, payload=_S,
)
RAW_EVENTS = StructType([*(f for f in ENVELOPE if f.name != "payload"), StructField("payload_json", _S), StructField("envelope_json", _S), StructField("row_version", _L)])

_FORECASTS = ("most_recent_forecast_mw", "most_recent_confidence_10_mw", "most_recent_confidence_90_mw", "day_ahead_forecast_mw", "day_ahead_confidence_10_mw", "day_ahead_confidence_90_mw", "week_ahead_forecast_mw")
_MORE_FORECASTS = ("day_ahead_11h_forecast_mw", "day_ahead_11h_confidence_10_mw", "day_ahead_11h_confidence_90_mw", "week_ahead_confidence_10_mw", "week_ahead_confidence_90_mw")
PRICES = ("alpha_eur_mwh", "alpha_prime_eur_mwh", "marginal_incremental_price_eur_mwh", "marginal_decremental_price_eur_mwh", "imbalance_price_eur_mwh")

IMBALANCE = _struct(event_id=_S, timestamp=_T, quarter_hour=_T, resolution_code=_S, quality_status=_S, ace_mw=_D, system_imbalance_mw=_D, **dict.fromkeys(PRICES, _D), ingested_at=_T, row_version=_L)
LOAD = _struct(event_id=_S, timestamp=_T, resolution_code=_S, measured_mw=_D, **dict.fromkeys(_FORECASTS, _D), monitored_capacity_mw=_D, load_factor=_D, ingested_at=_T, row_version=_L)
_PRODUCTION = dict(real_time_mw=_D, **dict.fromkeys(_FORECASTS + _MORE_FORECASTS, _D), monitored_capacity_mw=_D, load_factor=_D)
WIND = _struct(event_id=_S, timestamp=_T, resolution_code=_S, offshore_onshore=_S, region=_S, grid_connection_type=_S, **_PRODUCTION, decremental_bid_id=_S, ingested_at=_T, row_version=_L)
SOLAR = _struct(event_id=_S, timestamp=_T, resolution_code=_S, region=_S, **_PRODUCTION, ingested_at=_T, row_version=_L)
_VECTOR, _MASK = ArrayType(FloatType()), ArrayType(ByteType())
SNAPSHOTS = _struct(
    event_id=_S, cutoff=_T, target_time=_T, feature_schema_hash=_S, local_values=_VECTOR, local_masks=_MASK, context_values=_VECTOR, context_masks=_MASK,
    static_values=_VECTOR, static_masks=_MASK, current_state=_S, created_at=_T, row_version=_L,
)
PREDICTIONS = _struct(
    event_id=_S, cutoff=_T, target_time=_T, generated_at=_T, system_imbalance_mw=_D, p10_mw=_D, p90_mw=_D, flip_probability=FloatType(), will_flip=BooleanType(),
    current_state=_S, predicted_state=_S, prediction_quality=_S, model_version=_S, feature_schema_hash=_S, row_version=_L,
)
OUTCOMES = _struct(prediction_event_id=_S, target_time=_T, realized_event_id=_S, realized_system_imbalance_mw=_D, realized_state=_S, flip_actual=BooleanType(), evaluated_at=_T, row_version=_L)
MODELS = _struct(model_version=_S, feature_schema_hash=_S, manifest_json=_S, metrics_json=_S, promoted_at=_T, created_at=_T, row_version=_L)

#: Table name -> (schema, time column of its month partition, key columns of a revision).
TABLES = {
    "raw_events": (RAW_EVENTS, "event_time", ("event_id", "event_time", "row_version")),
    "imbalance_observations": (IMBALANCE, "timestamp", ("timestamp", "event_id", "row_version")),
    "load_observations": (LOAD, "timestamp", ("timestamp", "event_id", "row_version")),
    "wind_observations": (WIND, "timestamp", ("timestamp", "offshore_onshore", "region", "grid_connection_type", "event_id", "row_version")),
    "solar_observations": (SOLAR, "timestamp", ("timestamp", "region", "event_id", "row_version")),
    "feature_snapshots": (SNAPSHOTS, "target_time", ("target_time", "event_id", "row_version")),
    "predictions": (PREDICTIONS, "target_time", ("target_time", "model_version", "event_id", "row_version")),
    "prediction_outcomes": (OUTCOMES, "target_time", ("prediction_event_id", "target_time", "row_version")),
    "model_versions": (MODELS, "created_at", ("model_version", "created_at", "row_version")),
}


@dataclass(frozen=True)
class Registry:
    """What a snapshot holds and how its windows are laid out, in steps of ``step_seconds``."""

    step_seconds: int = 60
    deadband: float = 10.0
    local_steps: int = 180
    bin_steps: int = 15
    bins: int = 96
    min_observed: int = 30
    max_age: int = 5
    ewm: tuple[int, ...] = (5, 15, 60)
    median: tuple[int, ...] = (5, 15)
    slope: tuple[int, ...] = (5, 15)
    scale: tuple[int, ...] = (15, 60)
    zone: str = "Europe/Brussels"
    static: tuple[str, ...] = contract.names("static")

    local: tuple[str, ...] = contract.names("local")

    @property
    def history_steps(self) -> int:
        """Steps before the last bin's end that a snapshot looks at."""
        return self.bins * self.bin_steps - 1

    def fingerprint(self) -> str:
        """The contract's hash for minute steps; other step sizes add theirs, so that snapshots of different layouts don't mix."""
        base = contract.fingerprint(self.deadband, self.local_steps, self.bins, self.bin_steps, self.ewm, self.median, self.scale, self.slope)
        return base if self.step_seconds == 60 else hashlib.sha256(f"{base}:{self.step_seconds}".encode()).hexdigest()
