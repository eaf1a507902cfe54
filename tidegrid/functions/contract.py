"""The default feature contract and its fingerprint."""

from __future__ import annotations

import hashlib
import json

# Group, name, scaling kind and greatest source age in minutes of each feature, in order.
FEATURES = [
    ("local", "system_imbalance_mw", "robust", None),
    ("local", "ace_mw", "robust", None),
    ("local", "imbalance_price_eur_mwh", "robust", None),
    ("local", "marginal_incremental_price_eur_mwh", "robust", None),
    ("local", "marginal_decremental_price_eur_mwh", "robust", None),
    ("local", "quality_validated", "none", None),
    ("local", "delta_1_mw", "robust", None),
    ("local", "delta_2_mw", "robust", None),
    ("local", "acceleration_mw", "robust", None),
    ("local", "ewm_5_mw", "robust", None),
    ("local", "ewm_15_mw", "robust", None),
    ("local", "ewm_60_mw", "robust", None),
    ("local", "rolling_median_5_mw", "robust", None),
    ("local", "rolling_median_15_mw", "robust", None),
    ("local", "robust_scale_15_mw", "robust", None),
    ("local", "robust_scale_60_mw", "robust", None),
    ("local", "slope_5_mw_per_minute", "robust", None),
    ("local", "slope_15_mw_per_minute", "robust", None),
    ("local", "rolling_min_15_mw", "robust", None),
    ("local", "rolling_max_15_mw", "robust", None),
    ("local", "boundary_distance_mw", "robust", None),
    ("local", "confirmed_state_sign", "none", None),
    ("local", "state_duration_minutes", "log1p", None),
    ("local", "imbalance_age_minutes", "log1p", 5),
    ("context", "imbalance_mean_mw", "robust", None),
    ("context", "imbalance_min_mw", "robust", None),
    ("context", "imbalance_max_mw", "robust", None),
    ("context", "imbalance_std_mw", "robust", None),
    ("context", "imbalance_age_minutes", "log1p", 15),
    ("context", "load_actual_mw", "robust", 30),
    ("context", "load_forecast_mw", "robust", 60),
    ("context", "load_error_mw", "robust", 30),
    ("context", "load_actual_age_minutes", "log1p", 30),
    ("context", "wind_actual_mw", "robust", 30),
    ("context", "wind_forecast_mw", "robust", 60),
    ("context", "wind_error_mw", "robust", 30),
    ("context", "wind_forecast_spread_mw", "robust", 60),
    ("context", "wind_actual_age_minutes", "log1p", 30),
    ("context", "solar_actual_mw", "robust", 30),
    ("context", "solar_forecast_mw", "robust", 60),
    ("context", "solar_error_mw", "robust", 30),
    ("context", "solar_forecast_spread_mw", "robust", 60),
    ("context", "solar_actual_age_minutes", "log1p", 30),
    ("static", "quarter_hour_phase_sin", "none", None),
    ("static", "quarter_hour_phase_cos", "none", None),
    ("static", "minute_phase_sin", "none", None),
    ("static", "minute_phase_cos", "none", None),
    ("static", "hour_phase_sin", "none", None),
    ("static", "hour_phase_cos", "none", None),
    ("static", "weekday_phase_sin", "none", None),
    ("static", "weekday_phase_cos", "none", None),
    ("static", "day_of_year_phase_sin", "none", None),
    ("static", "day_of_year_phase_cos", "none", None),
    ("static", "is_weekend", "none", None),
    ("static", "is_belgian_holiday", "none", None),
    ("static", "is_dst_transition", "none", None),
]
# Policies that the fingerprint names.
POLICIES = {
    "source_profile": "imbalance-only-v1",
    "transform_version": "causal-v1",
    "missingness_policy": "zero-mask-causal-age-v1",
    "context_aggregation": "right-closed-15-minute-v1",
    "calendar_timezone": "Europe/Brussels",
}


def names(group: str) -> tuple[str, ...]:
    return tuple(name for own, name, _, _ in FEATURES if own == group)


def fingerprint(deadband: float, local_steps: int, bins: int, bin_steps: int, ewm, median, scale, slope) -> str:
    """SHA-256 of the contract as canonical JSON."""
    body = {
        **POLICIES, "features": [{"dtype": "float32", "group": g, "name": n, "scaling_kind": k, "max_source_age_minutes": age} for g, n, k, age in FEATURES],
        "deadband_mw": deadband, "local_window_minutes": local_steps, "context_steps": bins, "context_resolution_minutes": bin_steps,
        "ewm_windows": ewm, "median_windows": median, "robust_scale_windows": scale, "slope_windows": slope,
    }
    return hashlib.sha256(json.dumps(body, ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode()).hexdigest()
