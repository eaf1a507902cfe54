"""Feature snapshots: what was known at K about the steps before a cutoff, as arrays of values and masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contract
from ..functions.schemas import Registry
from ..functions.scratch import written
from ..functions.scalars import calendar, floor_steps, history_start, holidays, minute_range, shift, state_name, steps_between, with_holiday
from ..operators.grid import chunked_grid
from ..operators.pit import RANK, canonical_latest, day_level, day_revisions, pit_join, revisions_read, state_seed, summary_span, validity_intervals
from ..operators.windows import chunk_seeds, local_features, states

RAW = ("system_imbalance_mw", "ace_mw", "imbalance_price_eur_mwh", "marginal_incremental_price_eur_mwh", "marginal_decremental_price_eur_mwh", "quality_status")


def minute_features(obs: DataFrame, knowledge, reg: Registry, by: Sequence[str] = ("series",), chunk_steps: int = 1440) -> DataFrame:
    """Local features of every step for one knowledge time, each computed once whatever the number of cutoffs.

    Each chunk has the steps before it that the longest window reaches, and starts from what held before the chunk; no window is over a series.
    """
    known = canonical_latest(obs.select(*by, "timestamp", *RANK, *RAW), [*by, "timestamp"], knowledge).select(*by, "timestamp", *RAW)
    halo = max(*reg.ewm, *reg.median, *reg.scale, *reg.slope, 3)
    grid = chunked_grid(known, chunk_steps, halo, by, reg.step_seconds)
    part = [*by, "chunk"]
    alone = states(grid.where("not halo").select(*part, "timestamp", RAW[0]), part, RAW[0], reg.deadband, reg.step_seconds)
    seeded = grid.join(chunk_seeds(alone, by, "chunk", RAW[0]), part, "left")
    return local_features(seeded, part, reg, seeded=True).where("not halo").drop("halo", "chunk", "seed_sign", "seed_since", "seed_last")


def _vector(names: Sequence[str], present: dict[str, Column]) -> tuple[Column, Column]:
    """Values (0 where masked) and masks of a row of features."""
    cols = [present.get(n, F.lit(None).cast("double")).cast("double") for n in names]
    return F.array(*[F.coalesce(c, F.lit(0.0)).cast("float") for c in cols]), F.array(*[c.isNotNull().cast("tinyint") for c in cols])


#: The context columns that are filled; those of load, wind and solar are declared only: value 0, mask 0.
CONTEXT = contract.names("context")[:5]


def _assemble(history: DataFrame, requests: DataFrame, reg: Registry, by: Sequence[str]) -> DataFrame:
    """Snapshots from each request's dense, seeded history rows."""
    size = reg.bin_steps * reg.step_seconds
    f = local_features(history, ["request_id"], reg, seeded=True)
    values, masks = _vector(reg.local, {n: F.col(n) for n in reg.local})
    back = steps_between(F.col("timestamp"), F.col("cutoff"), reg.step_seconds)
    local = f.where(back < reg.local_steps).select("request_id", F.struct("timestamp", values.alias("v"), masks.alias("m"), "state_sign", "age", "system_imbalance_mw").alias("x"))
    local = local.groupBy("request_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    flat = lambda c, field: F.flatten(F.transform(c, lambda e: e[field]))
    last = F.element_at("x", -1)
    local = local.select(
        "request_id", flat("x", "v").alias("local_values"), flat("x", "m").alias("local_masks"), state_name(last["state_sign"]).alias("current_state"), last["age"].alias("age"),
        last["system_imbalance_mw"].alias("latest"), F.size(F.filter("x", lambda e: e["system_imbalance_mw"].isNotNull())).alias("observed"),
    )
    # bins end at the last boundary and so many steps before it
    end = floor_steps(F.col("cutoff"), size)
    number = F.floor(steps_between(F.col("timestamp"), end, reg.step_seconds) / reg.bin_steps)
    binned = f.where(F.col("timestamp") <= end).withColumn("__bin", number).groupBy("request_id", "__bin", "cutoff").agg(
        F.avg("system_imbalance_mw").alias("imbalance_mean_mw"), F.min("system_imbalance_mw").alias("imbalance_min_mw"), F.max("system_imbalance_mw").alias("imbalance_max_mw"),
        F.stddev_pop("system_imbalance_mw").alias("imbalance_std_mw"), F.max_by("age", "timestamp").alias("imbalance_age_minutes"),
    )
    cv, cm = _vector(contract.names("context"), {n: F.col(n) for n in CONTEXT})
    context = binned.select("request_id", F.struct((-F.col("__bin")).alias("at"), cv.alias("v"), cm.alias("m")).alias("x")).groupBy("request_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    context = context.select("request_id", flat("x", "v").alias("context_values"), flat("x", "m").alias("context_masks"))
    spark = requests.sparkSession
    years = requests.agg(F.min(F.year("cutoff")), F.max(F.year("cutoff"))).first()
    timed = with_holiday(requests.select("request_id", *by, "cutoff", "knowledge"), holidays(spark, (years[0] or 2024) - 1, (years[1] or 2024) + 1), zone=reg.zone)
    phases = {**calendar(F.col("cutoff"), reg.zone), "is_belgian_holiday": F.col("is_holiday")}
    sv, sm = _vector(reg.static, phases)
    out = timed.withColumn("static_values", sv).withColumn("static_masks", sm).join(local, "request_id").join(context, "request_id")
    eligible = (F.col("observed") >= reg.min_observed) & F.col("current_state").isNotNull() & F.coalesce(F.col("age") <= reg.max_age, F.lit(False))
    return out.withColumns({"model_eligible": eligible, "target_time": shift(F.col("cutoff"), reg.step_seconds), "created_at": F.col("knowledge"), "feature_schema_hash": F.lit(reg.fingerprint())}).drop("is_holiday")


def _seeds(obs: DataFrame, requests: DataFrame, reg: Registry, by: Sequence[str], intervals: DataFrame | None = None, days: DataFrame | None = None, span: int | None = None) -> DataFrame:
    start = history_start(F.col("cutoff"), reg.bins, reg.bin_steps, reg.step_seconds)
    asked = requests.select("request_id", *by, shift(start, -1).alias("before"), "knowledge")
    return state_seed(asked, obs, reg.deadband, by, intervals, days, span or summary_span(reg.step_seconds)).select("request_id", F.col("sign").alias("seed_sign"), F.col("state_since").alias("seed_since"), F.col("last_observed_at").alias("seed_last"))


def _steps(requests: DataFrame, reg: Registry, by: Sequence[str]) -> DataFrame:
    start = history_start(F.col("cutoff"), reg.bins, reg.bin_steps, reg.step_seconds)
    return requests.select("request_id", *by, "cutoff", "knowledge", F.explode(minute_range(start, F.col("cutoff"), reg.step_seconds)).alias("timestamp"))


def snapshots(obs: DataFrame, requests: DataFrame, reg: Registry, by: Sequence[str] = ("series",)) -> DataFrame:
    """Online form: each request filters the versions it knows and takes the latest of each step."""
    steps = _steps(requests, reg, by)
    seen = steps.join(obs.select(*by, "timestamp", *RANK, *RAW), [*by, "timestamp"]).where(F.col("ingested_at") <= F.col("knowledge"))
    best = seen.groupBy("request_id", "timestamp").agg(F.max_by(F.struct(*RAW), F.struct(*RANK)).alias("r")).select("request_id", "timestamp", "r.*")
    history = steps.join(best, ["request_id", "timestamp"], "left").join(_seeds(obs, requests, reg, by), "request_id")
    return _assemble(history, requests, reg, by)


def snapshots_pit(obs: DataFrame, requests: DataFrame, reg: Registry, by: Sequence[str] = ("series",), days: DataFrame | None = None) -> DataFrame:
    """Replay form for many (cutoff, knowledge): revisions become validity intervals once, and each step takes the one valid at its K.

    Revisions that no request can find are left out before that.  With a stored ``day_level`` of the whole history, ``obs`` needs no more
    than the steps that the requests look at (see ``state_seed``).  Requests are stored, since each part of a snapshot starts from them.
    """
    requests, span = written(requests.select("request_id", *by, "cutoff", "knowledge"), "asked"), 86400
    if days is None:
        span = summary_span(reg.step_seconds)
        days = written(day_level(validity_intervals(day_revisions(obs, by, span=span), [*by, "timestamp"]), reg.deadband, by, span=span), "days")
    day = lambda c: F.floor(F.unix_seconds(c) / 86400)
    before = shift(history_start(F.col("cutoff"), reg.bins, reg.bin_steps, reg.step_seconds), -1)
    reads = requests.select(*by, "knowledge", F.explode(F.sequence(F.least(day(before), day("knowledge")), day("cutoff"))).alias("day"))
    intervals = written(validity_intervals(revisions_read(obs, reads, by, RAW), [*by, "timestamp"], RAW), "intervals")
    history = pit_join(_steps(requests, reg, by), intervals, [*by, "timestamp"]).drop("valid_from", "valid_to", "event_id", "row_version")
    return _assemble(history.join(_seeds(obs, requests, reg, by, intervals, days, span), "request_id"), requests, reg, by)
