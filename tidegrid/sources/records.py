"""Sources: portal CSV, pages of JSON records, event logs and hourly weather arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ..functions.schemas import ENVELOPE
from ..functions.scratch import written

# Fixed names: the portal's CSV header, each with its field.
CSV_COLUMNS = {
    "Datetime": "timestamp",
    "Resolution code": "resolution_code",
    "Quarter hour": "quarter_hour",
    "Quality status": "quality_status",
    "ACE": "ace_mw",
    "System imbalance": "system_imbalance_mw",
    "Alpha": "alpha_eur_mwh",
    "Alpha'": "alpha_prime_eur_mwh",
    "Marginal incremental price": "marginal_incremental_price_eur_mwh",
    "Marginal decremental price": "marginal_decremental_price_eur_mwh",
    "Imbalance Price": "imbalance_price_eur_mwh",
}
# Fixed names: the record API's fields, each with ours.
IMBALANCE_FIELDS = {
    "datetime": "timestamp",
    "quarterhour": "quarter_hour",
    "resolutioncode": "resolution_code",
    "qualitystatus": "quality_status",
    "ace": "ace_mw",
    "systemimbalance": "system_imbalance_mw",
    "alpha": "alpha_eur_mwh",
    "alpha_prime": "alpha_prime_eur_mwh",
    "marginalincrementalprice": "marginal_incremental_price_eur_mwh",
    "marginaldecrementalprice": "marginal_decremental_price_eur_mwh",
    "imbalanceprice": "imbalance_price_eur_mwh",
}
_FORECAST_FIELDS = {
    "mostrecentforecast": "most_recent_forecast_mw",
    "mostrecentconfidence10": "most_recent_confidence_10_mw",
    "mostrecentconfidence90": "most_recent_confidence_90_mw",
    "dayaheadforecast": "day_ahead_forecast_mw",
    "dayaheadconfidence10": "day_ahead_confidence_10_mw",
    "dayaheadconfidence90": "day_ahead_confidence_90_mw",
    "weekaheadforecast": "week_ahead_forecast_mw",
}
_MORE_FORECAST_FIELDS = {
    "dayahead11hforecast": "day_ahead_11h_forecast_mw",
    "dayahead11hconfidence10": "day_ahead_11h_confidence_10_mw",
    "dayahead11hconfidence90": "day_ahead_11h_confidence_90_mw",
    "weekaheadconfidence10": "week_ahead_confidence_10_mw",
    "weekaheadconfidence90": "week_ahead_confidence_90_mw",
    "monitoredcapacity": "monitored_capacity_mw",
    "loadfactor": "load_factor",
}
LOAD_FIELDS = {"datetime": "timestamp", "resolutioncode": "resolution_code", "measured": "measured_mw", **_FORECAST_FIELDS}
SOLAR_FIELDS = {"datetime": "timestamp", "resolutioncode": "resolution_code", "region": "region", "realtime": "real_time_mw", **_FORECAST_FIELDS, **_MORE_FORECAST_FIELDS}
WIND_FIELDS = {**SOLAR_FIELDS, "offshoreonshore": "offshore_onshore", "gridconnectiontype": "grid_connection_type", "decrementalbidid": "decremental_bid_id"}
_TIMES, _TEXTS = ("timestamp", "quarter_hour"), ("resolution_code", "quality_status", "region", "offshore_onshore", "grid_connection_type", "decremental_bid_id")


def _typed(name: str, c: Column) -> Column:
    text = F.nullif(F.trim(c.cast("string")), F.lit(""))
    if name in _TIMES:
        return F.try_to_timestamp(text)
    return text if name in _TEXTS else F.try_cast(text, "double") if hasattr(F, "try_cast") else text.try_cast("double")


def record_schema(fields: dict[str, str]) -> StructType:
    """Records as text: conversion happens under our rules, so that a bad field is rejected and not silently nulled."""
    return StructType([StructField(k, StringType()) for k in fields])


def _normalised(df: DataFrame, fields: dict[str, str], resolution: str, required: tuple[str, ...]) -> DataFrame:
    """Renamed, typed columns and ``reason``, null for a valid record."""
    out = df.select(*[_typed(name, F.col(f"`{k}`")).alias(name) for k, name in fields.items()], *[(_typed(name, F.col(f"`{k}`")).isNull() & (F.trim(F.col(f"`{k}`").cast("string")) != "")).alias(f"__bad_{name}") for k, name in fields.items()])
    bad = [F.coalesce(F.col(f"__bad_{n}"), F.lit(False)) for n in fields.values()]
    unusable = bad[0]
    for b in bad[1:]:
        unusable = unusable | b
    for name in required:
        unusable = unusable | F.col(name).isNull()
    reason = F.when(F.coalesce(F.col("resolution_code") != resolution, F.lit(True)), "resolution").when(unusable, "invalid_record")
    return out.withColumn("reason", reason).drop(*[f"__bad_{n}" for n in fields.values()])


def normalize_imbalance(df: DataFrame) -> DataFrame:
    return _normalised(df, IMBALANCE_FIELDS, "PT1M", ("timestamp", "quarter_hour", "quality_status", "system_imbalance_mw"))


def normalize_load(df: DataFrame) -> DataFrame:
    return _normalised(df, LOAD_FIELDS, "PT15M", ("timestamp",))


def normalize_wind(df: DataFrame) -> DataFrame:
    return _normalised(df, WIND_FIELDS, "PT15M", ("timestamp", "offshore_onshore", "region", "grid_connection_type"))


def normalize_solar(df: DataFrame) -> DataFrame:
    return _normalised(df, SOLAR_FIELDS, "PT15M", ("timestamp", "region"))


def minute_rows(spark: SparkSession, path: str, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """The portal's semicolon CSV: blanks are null, offsets become UTC; a missing column, a bad row, a minute that occurs twice
    or an empty file is an error.  The text is parsed once, and its rows stored."""
    raw = spark.read.csv(path, sep=";", header=True, encoding="UTF-8")
    missing = [c for c in CSV_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"the CSV lacks the columns {missing}")
    extra = [c for c in keys if c in raw.columns]
    back = {v: k for k, v in IMBALANCE_FIELDS.items()}
    records = raw.select(*[F.col(f"`{c}`").alias(back[name]) for c, name in CSV_COLUMNS.items()], *extra)
    if extra:
        raise ValueError("keys must be normalised columns")
    checked = written(_normalised(records, IMBALANCE_FIELDS, "PT1M", ("timestamp", "quarter_hour", "quality_status", "system_imbalance_mw")), "minute-rows")
    counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad")).first()
    if not counts["n"]:
        raise ValueError("the CSV has no rows")
    if counts["bad"]:
        raise ValueError(f"{counts['bad']} rows of the CSV are invalid")
    if twice := checked.groupBy(*keys).count().where("count > 1").first():
        raise ValueError(f"the CSV has a minute twice: {twice[0]}")
    return checked.drop("reason")


def read_minute_csv(spark: SparkSession, path: str, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """``minute_rows``, sorted by time."""
    return minute_rows(spark, path, keys).orderBy("timestamp")


def read_record_pages(spark: SparkSession, path: str, fields: dict[str, str], lines: bool = False) -> DataFrame:
    """Records of pages {total_count, results}; a negative or missing count is an error.

    A page is a file, as the API answers it; with ``lines``, a line of a file that holds many, which can be split.
    """
    page = StructType([StructField("total_count", LongType()), StructField("results", ArrayType(record_schema(fields)))])
    pages = spark.read.schema(page).json(path, multiLine=not lines)
    if pages.where("total_count is null or total_count < 0").limit(1).count():
        raise ValueError("a page has no valid total_count")
    return pages.select(F.explode("results").alias("r")).select("r.*")


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False, files: int | None = None) -> DataFrame:
    """Event envelopes from JSON lines; the payload stays text.  ``files`` bounds those of a micro-batch."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.option("maxFilesPerTrigger", files) if streaming and files else reader
    return reader.schema(ENVELOPE).json(path)


WEATHER_VARIABLES = (
    "temperature_2m", "relative_humidity_2m", "pressure_msl", "cloud_cover", "shortwave_radiation", "direct_normal_irradiance", "wind_speed_10m", "wind_speed_100m",
    "wind_direction_100m", "wind_gusts_10m", "precipitation",
)


def weather_schema(variables: tuple[str, ...] = WEATHER_VARIABLES) -> StructType:
    hourly = StructType([StructField("time", ArrayType(StringType())), *[StructField(v, ArrayType(DoubleType())) for v in variables]])
    return StructType([StructField("location", StringType()), StructField("utc_offset_seconds", LongType()), StructField("hourly", hourly)])


def explode_weather(df: DataFrame, variables: tuple[str, ...] = WEATHER_VARIABLES) -> DataFrame:
    """(location, valid_time, variable, value) from a row of hourly arrays for each location.

    Arrays of unequal length, an offset from UTC, or locations with other hours are an error.
    """
    size = F.size("hourly.time")
    unequal = F.lit(False)
    for v in variables:
        unequal = unequal | F.coalesce(F.size(f"hourly.{v}") != size, F.lit(True))
    if df.where(unequal | F.coalesce(F.col("utc_offset_seconds") != 0, F.lit(True))).limit(1).count():
        raise ValueError("hourly arrays differ in length or are not in UTC")
    if df.agg(F.count_distinct(F.to_json("hourly.time"))).first()[0] > 1:
        raise ValueError("locations have different hours")
    zipped = df.select("location", F.explode(F.arrays_zip(F.col("hourly.time").alias("time"), *[F.col(f"hourly.{v}").alias(v) for v in variables])).alias("h"))
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"h.{v}").alias("value")) for v in variables])
    return zipped.select("location", F.to_timestamp("h.time").alias("valid_time"), F.explode(pairs).alias("p")).select("location", "valid_time", "p.*")


def aggregate_weather(df: DataFrame, directions: tuple[str, ...] = ("wind_direction_100m",), tolerance: float = 1e-12, by: tuple[str, ...] = ("valid_time", "variable")) -> DataFrame:
    """Mean, least, greatest and who reported, over locations; directions have a circular mean only, null if they cancel."""
    sine, cosine = F.avg(F.sin(F.radians("value"))), F.avg(F.cos(F.radians("value")))
    circular = F.when(F.hypot(sine, cosine) >= tolerance, F.pmod(F.degrees(F.atan2(sine, cosine)), F.lit(360.0)))
    out = df.groupBy(*by).agg(F.avg("value").alias("mean"), F.min("value").alias("minimum"), F.max("value").alias("maximum"), circular.alias("circular"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("location", F.col("value").isNotNull().alias("there"))))).alias("point_mask"))
    turning = F.col("variable").isin(*directions)
    return out.select(*by, F.when(turning, F.col("circular")).otherwise(F.col("mean")).alias("mean"), F.when(~turning, F.col("minimum")).alias("minimum"), F.when(~turning, F.col("maximum")).alias("maximum"), "point_mask")


def available_forecasts(df: DataFrame, cutoff, live: bool) -> DataFrame:
    """Forecasts known by the cutoff: live ones since they were received, historical ones since their valid time."""
    at = F.col("received_at") if live else F.col("valid_time")
    return df.withColumn("available_at", at).where(F.col("available_at") <= F.lit(cutoff).cast("timestamp"))
