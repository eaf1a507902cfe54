"""Scalar rules: states, flags, calendar, badges."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAU = 6.283185307179586


def advance_sign(previous: Column, value: Column, deadband: float) -> Column:
    """1 above the deadband, -1 below it, else the state before: on the boundary a state holds."""
    return F.when(value > deadband, 1).when(value < -deadband, -1).otherwise(previous)


def state_name(sign: Column) -> Column:
    return F.when(sign > 0, "positive").when(sign < 0, "negative")


def state_sign(state: Column) -> Column:
    return F.when(state == "positive", 1).when(state == "negative", -1)


def flip(current: Column, future: Column) -> Column:
    """Null if either state is unknown."""
    return current != future


def validated(quality: Column) -> Column:
    return F.lower(quality) == "validated"


def floor_steps(ts: Column, seconds: int) -> Column:
    """Start of the span of so many seconds, counted from the epoch in UTC."""
    return F.timestamp_seconds((F.floor(F.unix_seconds(ts) / seconds) * seconds).cast("bigint"))


def shift(ts: Column, seconds: Column | int) -> Column:
    s = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_seconds(F.unix_seconds(ts) + s)


def steps_between(start: Column, end: Column, step_seconds: int) -> Column:
    return (F.unix_seconds(end) - F.unix_seconds(start)) / float(step_seconds)


def minute_range(start: Column, end: Column, step_seconds: int = 60) -> Column:
    return F.transform(F.sequence(F.unix_seconds(start), F.unix_seconds(end), F.lit(step_seconds)), lambda s: F.timestamp_seconds(s))


def history_start(cutoff: Column, bins: int = 96, bin_steps: int = 15, step_seconds: int = 60) -> Column:
    """First step that the oldest bin of a snapshot looks at."""
    return shift(floor_steps(cutoff, bin_steps * step_seconds), -((bins - 1) * bin_steps + bin_steps - 1) * step_seconds)


def calendar(cutoff: Column, zone: str = "Europe/Brussels") -> dict[str, Column]:
    """Phases of the local clock and calendar, weekend and change-of-offset flags."""
    local = F.from_utc_timestamp(cutoff, zone)
    hour = F.hour(local) + F.minute(local) / 60.0
    phases = {"quarter_hour": (F.minute(local) % 15) / 15.0, "minute": F.minute(local) / 60.0, "hour": hour / 24.0, "weekday": F.weekday(local) / 7.0, "day_of_year": (F.dayofyear(local) - 1) / 366.0}
    out = {f"{name}_phase_{part}": fn(p * TAU) for name, p in phases.items() for part, fn in (("sin", F.sin), ("cos", F.cos))}
    offset = lambda at: F.unix_seconds(F.from_utc_timestamp(at, zone)) - F.unix_seconds(at)
    out["is_weekend"] = (F.weekday(local) >= 5).cast("double")
    out["is_dst_transition"] = (offset(shift(cutoff, -3600)) != offset(shift(cutoff, 3600))).cast("double")
    return out


def easter(year: int) -> date:
    """Easter Sunday by the Gregorian computus."""
    golden, century, rest = year % 19, *divmod(year, 100)
    moon = (19 * golden + century - century // 4 - (century - (century + 8) // 25 + 1) // 3 + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * (rest // 4) - moon - rest % 4) % 7
    late = (golden + 11 * moon + 22 * weekday) // 451
    month, day = divmod(moon + weekday - 7 * late + 114, 31)
    return date(year, month, day + 1)


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Public holidays of Belgium: fixed dates and those that follow Easter, ten to twelve rows a year."""
    fixed = ((1, 1), (5, 1), (7, 21), (8, 15), (11, 1), (11, 11), (12, 25))
    days = [(d,) for y in range(first_year, last_year + 1) for d in ([date(y, m, n) for m, n in fixed] + [easter(y) + timedelta(n) for n in (0, 1, 39, 49, 50)])]
    return spark.createDataFrame(sorted(set(days)), "holiday date")


def with_holiday(df: DataFrame, table: DataFrame, cutoff: str = "cutoff", zone: str = "Europe/Brussels") -> DataFrame:
    """Add is_holiday; the table is a dozen rows for each year, so it is broadcast."""
    named = F.broadcast(table.withColumn("__holiday", F.lit(1.0)))
    joined = df.withColumn("__day", F.to_date(F.from_utc_timestamp(F.col(cutoff), zone))).join(named, F.col("__day") == F.col("holiday"), "left")
    return joined.withColumn("is_holiday", F.coalesce("__holiday", F.lit(0.0))).drop("__day", "__holiday", "holiday")


def scaled(value: Column, mask: Column, location: Column, scale: Column, clip: float = 12.0) -> Column:
    """Robust scaling, cut at +-clip; 0 where masked."""
    return F.when(mask == 1, F.least(F.lit(clip), F.greatest(F.lit(-clip), (value - location) / scale))).otherwise(0.0)


def isotonic(p: Column, xs: Column, ys: Column) -> Column:
    """Linear interpolation between thresholds, held beyond them, in [0, 1]."""
    below = F.size(F.filter(xs, lambda x: x <= p))
    x0, x1, y0, y1 = F.get(xs, below - 1), F.get(xs, below), F.get(ys, below - 1), F.get(ys, below)
    inner = y0 + (y1 - y0) * (p - x0) / (x1 - x0)
    raw = F.when(below == 0, F.get(ys, F.lit(0))).when(below == F.size(xs), F.element_at(ys, -1)).otherwise(inner)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw))


def result_badge(predicted: Column, realised: Column) -> Column:
    return F.when(realised.isNull() | predicted.isNull(), "pending").when(predicted == realised, "correct").otherwise("incorrect")


def phase_cohort(cutoff: Column) -> Column:
    m = F.minute(cutoff) % 15
    return F.when(m < 5, "quarter_hour_phase_start").when(m < 10, "quarter_hour_phase_middle").otherwise("quarter_hour_phase_end")


def predicted_state(current: Column, will_flip: Column, median: Column, deadband: float = 10.0) -> Column:
    """A known state, turned over if a flip is forecast; an unknown one follows the median forecast."""
    turned = F.when(current == "positive", "negative").when(current == "negative", "positive")
    return F.when(current.isNull(), state_name(advance_sign(F.lit(None), median, deadband))).otherwise(F.when(will_flip, turned).otherwise(current))
