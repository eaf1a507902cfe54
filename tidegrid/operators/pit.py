"""Point-in-time reads of revisioned rows: what was known at time K about time T.

Filters on time and knowledge stand before every aggregation, where Parquet sees them; the canonical revision is a ``max_by``
over a struct, which combines on the map side and keeps the winner's nulls.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import written
from . import stretches

RANK = ("row_version", "ingested_at", "event_id")


def time_range(df: DataFrame, start=None, end=None, col: str = "timestamp", closed: bool = False) -> DataFrame:
    """start <= t < end (<= with ``closed``); a null bound is open.  Tables with a ``month`` partition are pruned by it."""
    c = F.col(col)
    for bound, test in ((start, c >= F.lit(start)), (end, (c <= F.lit(end)) if closed else (c < F.lit(end)))):
        if bound is not None:
            df = df.where(test)
            if "month" in df.columns:
                month = F.date_format(F.lit(bound).cast("timestamp"), "yyyy-MM")
                df = df.where(F.col("month") >= month if bound is start else F.col("month") <= month)
    return df


def known_at(df: DataFrame, knowledge, col: str = "ingested_at") -> DataFrame:
    return df if knowledge is None else df.where(F.col(col) <= F.lit(knowledge))


def versions(df: DataFrame, start, end, knowledge, order: Sequence[str] = ("timestamp", *RANK)) -> DataFrame:
    """All revisions of [start, end] known by K, in order."""
    return known_at(time_range(df, start, end, closed=True), knowledge).orderBy(*order)


def latest_revision(df: DataFrame, keys: Sequence[str], rank: Sequence[str] = RANK, columns: Sequence[str] | None = None) -> DataFrame:
    """The row of highest rank for each key."""
    rest = [c for c in (columns or df.columns) if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*rank)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*")


def canonical_latest(df: DataFrame, keys: Sequence[str] = ("series", "timestamp"), knowledge=None) -> DataFrame:
    return latest_revision(known_at(df, knowledge), keys)


def window_known(df: DataFrame, cutoff, steps: int, knowledge, step_seconds: int = 60, keys: Sequence[str] = ("series", "timestamp")) -> DataFrame:
    """Canonical rows of (cutoff - steps, cutoff] as known at K, in time order."""
    at = F.lit(cutoff).cast("timestamp")
    inside = df.where((F.col("timestamp") > F.timestamp_seconds(F.unix_seconds(at) - steps * step_seconds)) & (F.col("timestamp") <= at))
    return canonical_latest(inside, keys, knowledge).orderBy(*keys)


def canonical_predictions(df: DataFrame) -> DataFrame:
    return latest_revision(df, ("event_id",), ("row_version", "generated_at"))


def canonical_outcomes(df: DataFrame) -> DataFrame:
    return latest_revision(df, ("prediction_event_id", "target_time"), ("row_version", "evaluated_at", "realized_event_id"))


#: Blocks of days, each of so many of the level below.
FANOUT_BITS = 3
#: Blocks of steps within a day, likewise.
_STEP_BITS = 4
_DAY = 86400


def summary_span(step_seconds: int) -> int:
    """Seconds of what is summarised as a day: an hour of minutes, so that a request reads dozens of steps one by one; a day at most."""
    return min(_DAY, 60 * step_seconds)


def _collapsed(at: Column, start: Column, seconds: int) -> Column:
    """What becomes known inside a span counts from its end on: whoever asks in between reads the span step by step."""
    end = F.timestamp_seconds(F.unix_seconds(start) + seconds)
    return F.when((at > start) & (at < end), end).otherwise(at)


def _start(block: Column, seconds: int) -> Column:
    return F.timestamp_seconds(block * seconds)


def _block_versions(level: DataFrame, by: Sequence[str], bits: int, seen: Column) -> DataFrame:
    """(by, block, seen, stretch) of blocks of 2 ** ``bits`` from versions of their parts in the same columns: one row for each change of a part."""
    n = 1 << bits
    up, child = F.shiftright("block", bits), F.col("block").bitwiseAND(n - 1)
    newest = [F.max_by("stretch", F.when(child == k, F.col("seen"))).alias(f"c{k}") for k in range(n)]
    known = [F.max(F.when(child == k, True)).alias(f"k{k}") for k in range(n)]
    wide = level.groupBy(*by, up.alias("up"), seen.alias("at")).agg(*newest, *known)
    w = Window.partitionBy(*by, "up").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # changes after the block's end
    parts = F.array(*[F.last(F.when(F.col(f"k{k}"), F.col(f"c{k}")), True).over(w) for k in range(n)])
    return wide.select(*by, F.col("up").alias("block"), F.col("at").alias("seen"), parts.alias("parts")).select(*by, "block", "seen", stretches.in_order(F.col("parts")).alias("stretch"))


def day_level(intervals: DataFrame, deadband: float, by: Sequence[str] = ("series",), value: str = "system_imbalance_mw", span: int = _DAY) -> DataFrame:
    """(by, block, seen, stretch): what each day held, from when on; days are counted from 1970, and may be of ``span`` seconds instead.

    A day has a version at its end, one for each later change, and one for each change before it began.  The steps of a day are numbered
    and combined by blocks of 16, 256, ...: a change adds a row to each level, and doesn't read the day's other changes again.
    """
    sign = F.when(F.col(value) > deadband, 1).when(F.col(value) < -deadband, -1)
    day, at = F.floor(F.unix_seconds("timestamp") / span), F.when(F.col("sign").isNotNull(), F.col("timestamp"))
    steps = intervals.select(*by, day.alias("day"), "timestamp", sign.alias("sign"), "valid_from").withColumn("seen", _collapsed(F.col("valid_from"), _start(F.col("day"), span), span))
    steps = steps.groupBy(*by, "day", "timestamp", "seen").agg(F.max_by(F.struct("sign"), "valid_from").alias("x")).select(*by, "day", "timestamp", "seen", "x.sign")
    number = F.dense_rank().over(Window.partitionBy(*by, "day").orderBy("timestamp")) - 1  # changes of one day of a series
    level = written(steps.select(*by, "day", number.cast("bigint").alias("block"), "seen", stretches.stretch(F.col("sign"), at, F.col("sign"), at, F.col("timestamp")).alias("stretch")), "steps")
    most = level.agg(F.max("block")).first()[0] or 0
    while True:
        level, most = _block_versions(level, [*by, "day"], _STEP_BITS, F.col("seen")), most >> _STEP_BITS
        if not most:
            return level.select(*by, F.col("day").alias("block"), "seen", "stretch")


def day_summaries(days: DataFrame, by: Sequence[str] = ("series",), span: int = _DAY) -> tuple[DataFrame, int, int]:
    """From a stored ``day_level``: (by, level, block, valid_from, valid_to, stretch), its highest level, and the first block of that.

    Above the days stand blocks of 8, 64, ... days.  A block has a version at its end and one for each change of its days after that: a
    correction adds a row to each level, and touches no day but its own.
    """
    level = days
    lo, hi = level.agg(F.min("block"), F.max("block")).first()
    levels, n, depth = [level.withColumn("level", F.lit(0))], 1 << FANOUT_BITS, 0
    while lo is not None and (hi >> FANOUT_BITS * depth) - (lo >> FANOUT_BITS * depth) >= n:
        depth += 1
        seconds = n**depth * span
        seen = _collapsed(F.col("seen"), _start(F.shiftright("block", FANOUT_BITS), seconds), seconds)
        level = written(_block_versions(level, by, FANOUT_BITS, seen), "blocks")
        levels.append(level.withColumn("level", F.lit(depth)))
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    w = Window.partitionBy(*by, "level", "block").orderBy("seen")
    table = every.select(*by, "level", "block", F.col("seen").alias("valid_from"), F.lead("seen").over(w).alias("valid_to"), "stretch")
    return table, depth, (lo or 0) >> FANOUT_BITS * depth


def _numbered(level: int, block: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), block.alias("block"))


def state_seed(requests: DataFrame, obs: DataFrame, deadband: float, by: Sequence[str] = ("series",), intervals: DataFrame | None = None, days: DataFrame | None = None, span: int = _DAY) -> DataFrame:
    """For each request (request_id, series, before, knowledge): sign, since when, and last observation, as known then.

    Whole days before both times come from ``day_summaries``, seven blocks of each level at most, whatever was corrected, and when.  The
    days of the two times themselves are read step by step, and steps that were known before their day began.
    ``intervals`` are the validity intervals of ``obs``, if they are there already; ``days`` a stored ``day_level`` of the whole
    history: then ``obs`` needs to hold the days of the two times alone, and nothing known before its day.  Days are of ``span`` seconds.
    """
    value = "system_imbalance_mw"
    iv = intervals if intervals is not None else written(validity_intervals(obs, [*by, "timestamp"], (value,)), "intervals")
    iv = iv.select(*by, "timestamp", "valid_from", "valid_to", F.col(value).alias("v"))
    blocks, top, least = day_summaries(days if days is not None else written(day_level(iv.withColumnRenamed("v", value), deadband, by, span=span), "days"), by, span)
    day = lambda c: F.floor(F.unix_seconds(c) / span)
    near = written(requests.select("request_id", *by, "before", "knowledge", day("before").alias("d"), day("knowledge").alias("k")).withColumn("n", F.least("d", "k")), "requests")
    some = lambda a, b: F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
    wanted = []
    for depth in range(top + 1):
        here = F.shiftright("n", FANOUT_BITS * depth)
        first = F.lit(least).cast("bigint") if depth == top else F.shiftleft(F.shiftright("n", FANOUT_BITS * (depth + 1)), FANOUT_BITS)
        wanted.append((depth, some(first, here)))
    asked = near.select("request_id", *by, "knowledge", F.explode(F.concat(*[F.transform(blocks_of, partial(_numbered, depth)) for depth, blocks_of in wanted])).alias("w")).select("request_id", *by, "knowledge", "w.*")
    met = pit_join(asked, blocks, [*by, "level", "block"]).where("stretch is not null")
    begin = F.col("block") * F.pow(F.lit(float(1 << FANOUT_BITS)), F.col("level"))
    whole = met.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct(begin.alias("begin"), "stretch"))).alias("xs")).select("request_id", stretches.in_order(F.transform("xs", lambda x: x["stretch"])).alias("p"))
    near = written(near.join(whole, "request_id", "left").select("request_id", *by, "before", "knowledge", "d", "k", F.col("p.sign").alias("p_sign"), F.col("p.since").alias("p_since"), F.col("p.last").alias("p_last")), "seeds")
    valid = (F.col("timestamp") <= F.col("before")) & (F.col("valid_from") <= F.col("knowledge")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("knowledge")))
    open_days = near.withColumn("day", F.explode(F.array_distinct(F.array(F.least("d", "k"), "d"))))
    columns = ["request_id", "timestamp", "v", "p_sign"]
    steps = open_days.join(iv.withColumn("day", day("timestamp")), [*by, "day"]).where(valid).select(*columns)
    early = iv.where(F.unix_seconds("valid_from") < day("timestamp") * span)
    between = (day("timestamp") > F.col("k")) & (day("timestamp") < F.col("d"))
    steps = steps.unionByName(near.where("k + 1 < d").join(early, list(by)).where(valid & between).select(*columns))
    sign = F.when(F.col("v") > deadband, 1).when(F.col("v") < -deadband, -1)
    w = Window.partitionBy("request_id").orderBy("timestamp")  # two days of steps
    signs = steps.withColumn("sign", sign).withColumn("state", F.coalesce(F.last("sign", True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "p_sign"))
    signs = signs.withColumn("was", F.coalesce(F.lag("state").over(w), F.col("p_sign"), F.lit(0)))
    states = signs.groupBy("request_id").agg(F.max_by("state", "timestamp").alias("sign"), F.max(F.when(F.col("state") != F.col("was"), F.col("timestamp"))).alias("since"), F.max("timestamp").alias("last"))
    found = near.select("request_id", "p_sign", "p_since", "p_last").join(states, "request_id", "left")
    found = found.select("request_id", F.coalesce("sign", "p_sign").alias("sign"), F.coalesce("since", "p_since").alias("state_since"), F.coalesce("last", "p_last").alias("last_observed_at"))
    return requests.join(found, "request_id", "left")


def validity_intervals(df: DataFrame, keys: Sequence[str] = ("series", "timestamp"), columns: Sequence[str] = ("system_imbalance_mw",), rank: Sequence[str] = RANK) -> DataFrame:
    """When each revision was the canonical one: [valid_from, valid_to) in knowledge time, open while it still is.

    The running best by rank over availability; changes of the winner open and close intervals.
    """
    w = Window.partitionBy(*keys).orderBy("ingested_at")
    best = F.max(F.struct(*rank, F.struct(*columns).alias("row"))).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    first = df.withColumn("best", best).groupBy(*keys, "ingested_at").agg(F.first("best").alias("best"))
    changed = first.withColumn("was", F.lag("best").over(w)).where(F.col("was").isNull() | (F.col("was") != F.col("best")))
    return changed.select(*keys, F.col("ingested_at").alias("valid_from"), F.lead("ingested_at").over(w).alias("valid_to"), "best.event_id", "best.row_version", "best.row.*")


def _best(df: DataFrame, keys: Sequence[str], columns: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """The revision of highest rank for each key, as ``validity_intervals`` compares them."""
    best = F.max(F.struct(*rank, F.struct(*columns).alias("row"))).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *[f"best.{c}" for c in rank], "best.row.*")


def day_revisions(df: DataFrame, by: Sequence[str] = ("series",), columns: Sequence[str] = ("system_imbalance_mw",), rank: Sequence[str] = RANK, span: int = _DAY) -> DataFrame:
    """The revisions that ``day_level`` tells apart: of those of a step that came inside its day, the one that held at the day's end.

    They are reduced before the shuffle; the validity intervals of what is left give the same ``day_level`` as those of all.
    """
    seen = _collapsed(F.col("ingested_at"), _start(F.floor(F.unix_seconds("timestamp") / span), span), span)
    return _best(df.withColumn("__seen", seen), [*by, "timestamp", "__seen"], columns, rank).drop("__seen")


def _before(times: Column, halves: Column, at: Column) -> Column:
    """How many of the sorted times are before one: a binary search in steps of ``halves``, powers of two that end with 1."""
    return F.aggregate(halves, F.lit(0), lambda n, step: F.when(F.get(times, n + step - 1) < at, n + step).otherwise(n))


def revisions_read(df: DataFrame, reads: DataFrame, by: Sequence[str] = ("series",), columns: Sequence[str] = ("system_imbalance_mw",), rank: Sequence[str] = RANK) -> DataFrame:
    """The revisions that can be found at the times at which their day is read (``reads``: by, day, knowledge; days count from 1970).

    Of a step's revisions between two such times only the best can be found, and none after the last.  They are reduced before the shuffle;
    at these times the validity intervals of what is left say the same as those of all.
    """
    times = reads.groupBy(*by, "day").agg(F.sort_array(F.collect_set("knowledge")).alias("__times"))
    powers = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size("__times"))).cast("int")), lambda i: F.pow(F.lit(2.0), i).cast("int"))
    times = written(times.withColumn("__halves", F.reverse(powers)), "times")
    near = df.withColumn("day", F.floor(F.unix_seconds("timestamp") / _DAY)).join(times, [*by, "day"])
    found = near.withColumn("__n", _before(F.col("__times"), F.col("__halves"), F.col("ingested_at"))).where(F.col("__n") < F.size("__times"))
    return _best(found, [*by, "timestamp", "__n"], columns, rank).drop("__n")


def pit_join(wanted: DataFrame, intervals: DataFrame, keys: Sequence[str] = ("series", "timestamp"), knowledge: str = "knowledge") -> DataFrame:
    """Left join of (keys, knowledge) with the revision that was canonical then: an equi join with a residual on the interval."""
    i = intervals.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in intervals.columns if c not in keys])
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("valid_from") <= F.col(knowledge), F.col("valid_to").isNull() | (F.col(knowledge) < F.col("valid_to"))]
    return wanted.join(i, on, "left").drop(*[f"__{k}" for k in keys])


def store_intervals(intervals: DataFrame, table: str, path: str, buckets: int, keys: Sequence[str] = ("series", "timestamp")) -> DataFrame:
    """Keep validity intervals as a table bucketed and sorted by their keys, at ``path``, and read it.

    ``pit_join`` on these keys then takes the history as it lies: only what is wanted is shuffled, into as many parts.  ``buckets`` follows
    from the size: some 128 MB each.
    """
    spark = intervals.sparkSession
    rows = intervals.repartition(buckets, *keys)  # one file a bucket
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys, "valid_from").saveAsTable(table)
    return spark.table(table)


def realised_join(predictions: DataFrame, realised: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Realisations with the predictions of their time that were made before they were available."""
    on = [predictions["target_time"] == realised["timestamp"], predictions["generated_at"] <= realised["available_at"], *(predictions[c] == realised[c] for c in by)]
    return predictions.join(realised.drop(*by) if not by else realised, on, "inner")


def with_outcomes(predictions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Canonical predictions with their outcome, nulls while it is pending."""
    o = canonical_outcomes(outcomes).withColumnRenamed("prediction_event_id", "event_id").drop("row_version")
    return canonical_predictions(predictions).join(o, ["event_id", "target_time"], "left")
