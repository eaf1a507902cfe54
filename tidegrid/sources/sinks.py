"""Sinks: typed month-partitioned tables, audit rows, dead letters, dataset exports with manifests, compaction."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.identity import event_id, row_version
from ..functions.schemas import TABLES


CODEC = "zstd"  # identities are hex text, which snappy leaves as long as it is


def write_typed(df: DataFrame, table: str, root: str, mode: str = "append", batch: int | None = None, derive: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Append rows in the table's schema, missing columns as null, by month of its time, sorted so that files can be skipped.

    With ``batch``, they go into that batch's own folder of the table (see ``commit_batch``).  ``derive`` makes the table's rows of ``df``,
    which has the time already: it runs where the rows are written, so that what it adds isn't shuffled.
    """
    schema, time, keys = TABLES[table]
    path = f"{root}/{table}" if batch is None else batch_path(root, table, batch)
    month, day = F.date_format(time, "yyyy-MM"), F.date_trunc("DAY", F.col(time))
    made = derive(df.repartition(month, day)) if derive else df
    have = set(made.columns)
    rows = made.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], month.alias("month"))
    placed = rows if derive else rows.repartition("month", day)
    placed.sortWithinPartitions("month", *keys).write.mode(mode).option("compression", CODEC).partitionBy("month").parquet(path)
    return path


def read_typed(spark: SparkSession, table: str, root: str) -> DataFrame:
    schema, _, _ = TABLES[table]
    return spark.read.schema(StructType([*schema.fields, StructField("month", StringType())])).parquet(f"{root}/{table}")


def _paths(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_COMMITS = "commits"


def _name(batch_id: int) -> str:
    return f"batch={batch_id:010d}"


def batch_path(root: str, table: str, batch_id: int) -> str:
    return f"{root}/{table}/{_name(batch_id)}"


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    marker, disk = _paths(spark, f"{root}/{_COMMITS}/{_name(batch_id)}.json")
    return disk.exists(marker)


def committed(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The batches that were stored whole, each with its tables: a small file for each."""
    where, disk = _paths(spark, f"{root}/{_COMMITS}")
    if not disk.exists(where):
        return {}
    return {r["batch"]: list(r["tables"]) for r in spark.read.schema("batch string, tables array<string>").json(f"{root}/{_COMMITS}").collect()}


def commit_batch(spark: SparkSession, root: str, batch_id: int, tables: Sequence[str]) -> None:
    """Say that a batch is whole: the marker is written under another name and renamed."""
    name = _name(batch_id)
    marker, disk = _paths(spark, f"{root}/{_COMMITS}/{name}.json")
    temporary, _ = _paths(spark, f"{root}/{_COMMITS}/_{name}.{uuid.uuid4().hex}")
    out = disk.create(temporary, True)
    out.writeBytes(json.dumps({"batch": name, "tables": sorted(tables)}))
    out.close()
    if not disk.rename(temporary, marker) and not disk.exists(marker):
        raise OSError(f"{name} can't be committed")


def read_committed(spark: SparkSession, table: str, root: str) -> DataFrame:
    """A table's rows of all committed batches; what an unfinished batch has written isn't read."""
    paths = [f"{root}/{table}/{batch}" for batch, tables in sorted(committed(spark, root).items()) if table in tables]
    schema = StructType([*TABLES[table][0].fields, StructField("month", StringType())]) if table in TABLES else None
    if not paths:
        return spark.createDataFrame([], schema or StructType())
    return (spark.read.schema(schema) if schema else spark.read).option("basePath", f"{root}/{table}").parquet(*paths)


def raw_rows(envelopes: DataFrame) -> DataFrame:
    """The audit row of each envelope: its payload and its whole text as canonical JSON, and a row version."""
    fields = sorted(c for c in envelopes.columns if c != "payload")
    whole = F.to_json(F.struct(*[F.col(c) for c in fields], F.col("payload")), {"ignoreNullFields": "false"})
    return envelopes.select(*[c for c in envelopes.columns if c != "payload"], F.col("payload").alias("payload_json"), whole.alias("envelope_json"), row_version("ingested_at", "event_id").alias("row_version"))


def write_raw_then_typed(envelopes: DataFrame, typed: dict[str, DataFrame], root: str) -> None:
    """Audit rows first, so that no typed row lacks its source."""
    write_typed(envelopes, "raw_events", root, derive=raw_rows)
    for table, df in typed.items():
        write_typed(df, table, root)


def dead_letters(rejected: DataFrame, service: str = "sink", deliveries: str | None = None) -> DataFrame:
    """Rejected envelopes whole, with reason and delivery count, under an id that a replay repeats."""
    columns = [c for c in rejected.columns if c not in ("reason", deliveries)]
    return rejected.select(
        event_id(F.lit(service), F.lit("dead-letter"), F.coalesce("event_id", F.lit("")), F.coalesce("schema_version", F.lit(""))).alias("dead_letter_id"), "reason",
        (F.col(deliveries) if deliveries else F.lit(1)).cast("int").alias("delivery_count"), F.struct(*columns).alias("original_event"),
    )


def dataset_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256, rows) of each shard.  A shard's bytes are hashed where they are read, a few megabytes each."""
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    digests = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(name(F.col("path")).alias("file"), F.sha2("content", 256).alias("sha256"))
    counts = spark.read.parquet(path).groupBy(name(F.input_file_name()).alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return digests.join(counts, "file", "left").select("file", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"))


def dataset_metadata(df: DataFrame, hash_col: str = "feature_schema_hash", time: str = "cutoff") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("examples"), F.min(time).alias("first_cutoff"), F.max(time).alias("last_cutoff"), F.count_distinct(hash_col).alias("schemas"), F.min(hash_col).alias("feature_schema_hash"))


def export_dataset(df: DataFrame, path: str, force: bool = False, shards: int | None = None) -> dict:
    """Write examples by ranges of cutoff under a temporary name, check, rename, and leave metadata.json beside the shards.

    One schema hash and at least one example are required; an existing dataset is replaced only with ``force``.
    """
    spark = df.sparkSession
    final, disk = _paths(spark, path)
    if disk.exists(final) and not force:
        raise FileExistsError(path)
    staged, _ = _paths(spark, path.rstrip("/") + ".staged")
    ranged = df.repartitionByRange(shards, "cutoff") if shards else df.repartitionByRange("cutoff")
    ranged.sortWithinPartitions("cutoff").write.mode("overwrite").parquet(staged.toString())
    meta = dataset_metadata(spark.read.parquet(staged.toString())).first()
    if not meta["examples"] or meta["schemas"] != 1:
        disk.delete(staged, True)
        raise ValueError("a dataset needs examples of one feature schema")
    files = [r.asDict() for r in dataset_manifest(spark, staged.toString()).orderBy("file").toLocalIterator()]  # a row for each shard
    out = {"examples": meta["examples"], "first_cutoff": str(meta["first_cutoff"]), "last_cutoff": str(meta["last_cutoff"]), "feature_schema_hash": meta["feature_schema_hash"], "shards": files}
    out["digest"] = hashlib.sha256(json.dumps(out, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    spark.createDataFrame([(json.dumps(out, sort_keys=True),)], "value string").coalesce(1).write.text(f"{staged.toString()}/_metadata")
    before, _ = _paths(spark, path.rstrip("/") + ".before")
    if disk.exists(final):  # the old dataset stays until the new one is in its place
        disk.delete(before, True)
        disk.rename(final, before)
    if not disk.rename(staged, final):
        disk.rename(before, final)
        raise OSError(f"{path} can't be put in its place")
    disk.delete(before, True)
    return out


def verify_dataset(spark: SparkSession, path: str) -> dict:
    """Read the metadata and compare its digest and every shard's; a difference is an error."""
    meta = json.loads(spark.read.text(f"{path}/_metadata").first()[0])
    digest = meta.pop("digest")
    if hashlib.sha256(json.dumps(meta, sort_keys=True, separators=(",", ":")).encode()).hexdigest() != digest:
        raise ValueError("the metadata differs from its digest")
    now = dataset_manifest(spark, path)
    then = spark.createDataFrame([(x["file"], x["sha256"], x["rows"]) for x in meta["shards"]], "file string, sha256 string, rows bigint")
    if now.exceptAll(then).limit(1).count() or then.exceptAll(now).limit(1).count():
        raise ValueError("a shard differs from the manifest")
    return {**meta, "digest": digest}


def compact(df: DataFrame, table: str, now: datetime | None = None, retention_days: int = 90) -> DataFrame:
    """Exact duplicate revisions once; raw events older than the retention are left out."""
    _, time, keys = TABLES[table]
    if table == "raw_events" and now is not None:
        df = df.where(F.col(time) >= F.lit(now - timedelta(days=retention_days)))
    return df.dropDuplicates([k for k in keys if k in df.columns])


def compact_table(spark: SparkSession, table: str, root: str, now: datetime | None = None, retention_days: int = 90) -> list[str]:
    """Compact a table in place, and return the months that changed.

    Only months with duplicate revisions or expired rows are read whole and replaced, by a dynamic overwrite of their partitions; months
    of which nothing is left are deleted.  So a second compaction rewrites nothing.  Months are found by two hashes of the keys, which
    are a fifth of the keys to shuffle; rows are told apart by the keys themselves, so two keys of equal hashes would both stay.
    """
    _, time, keys = TABLES[table]
    rows = read_typed(spark, table, root)
    old = (F.col(time) < F.lit(now - timedelta(days=retention_days))) if table == "raw_events" and now is not None else F.lit(False)
    own = rows.select("month", F.xxhash64(*keys).alias("h"), F.xxhash64(F.lit(1), *keys).alias("g"), time)
    groups = own.groupBy("month", "h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce(old, F.lit(False))).alias("old"))
    months = groups.groupBy("month").agg(F.max((F.col("n") > 1) | F.col("old")).alias("changed"), F.min("old").alias("gone")).where("changed").collect()  # a row for each month
    kept = [r["month"] for r in months if not r["gone"]]
    if kept:
        new = compact(rows.where(F.col("month").isin(kept)), table, now, retention_days).repartition("month", F.date_trunc("DAY", F.col(time))).sortWithinPartitions("month", *keys)
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy("month").parquet(f"{root}/{table}")
    for r in months:
        if r["gone"]:
            path, disk = _paths(spark, f"{root}/{table}/month={r['month']}")
            disk.delete(path, True)
    return sorted(r["month"] for r in months)
