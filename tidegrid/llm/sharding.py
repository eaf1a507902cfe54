"""Shards in random order: a two-pass external shuffle, in DataFrame functions alone.

Pass one scatters rows uniformly into buckets of about ``bucket_bytes`` by a seeded hash.  Pass two takes one bucket in a task,
puts it in order of that hash, permutes it by Fisher-Yates (Spark's ``shuffle``, seeded by the bucket's number) and writes it.  The
buckets one after another are a uniformly random order of all rows; it is cut into shards whose counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import BROADCAST_ROWS, ROW, intermediate, scratch, stored, with_numbers

SEED = 20240229
#: Bytes of text that a bucket holds: a task has them in memory a few times over.
BUCKET_BYTES = 32 << 20
#: Buckets whose counts are added up in one window; the sums of such runs are added up in another.
_RUN = 1024


def _bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def _salted(rows: DataFrame, repeated: DataFrame, n: int) -> DataFrame:
    """Add ``salt``: the row's number where its key comes more than once, else 0, so that equal rows are scattered as all others."""
    if not n:
        return rows.withColumn("salt", F.lit(0).cast("bigint"))
    again = repeated.select("key", F.lit(True).alias("again"))
    again = F.broadcast(again) if n <= BROADCAST_ROWS else again.hint("merge")
    return rows.join(again, "key", "left").withColumn("salt", F.when(F.col("again"), F.col("number")).otherwise(0).cast("bigint")).drop("again")


def _offsets(counts: DataFrame) -> DataFrame:
    """bucket, first (rows in the buckets before it) and total, from (bucket, n): windows over runs of buckets, then over the runs."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("run", F.floor(F.col("bucket") / _RUN))
    inside = runs.withColumn("inner", F.coalesce(F.sum("n").over(before(Window.partitionBy("run").orderBy("bucket"))), F.lit(0)))
    sums = runs.groupBy("run").agg(F.sum("n").alias("n"))  # a row for each thousand tasks
    sums = sums.select("run", F.coalesce(F.sum("n").over(before(Window.orderBy("run"))), F.lit(0)).alias("outer"), F.sum("n").over(Window.partitionBy()).alias("total"))
    return inside.join(sums, "run").select("bucket", (F.col("inner") + F.col("outer")).alias("first"), "total")


def shuffle_into_shards(docs: DataFrame, shards: int, folder: str | None = None, *, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all rows of ``docs`` in random order, by shard, and read them back: ``row`` (all columns of docs), ``shard`` and ``slot``.

    Slots of a shard count from 0 without a gap; counts of shards differ by one at most, and fewer rows than shards leave
    shards empty.  The order follows from seed, bucket_bytes, doc_id and text alone, whatever the cluster or a task's second
    attempt; only rows that are equal in both are told apart by their place in the files.  Null and empty texts count no
    bytes; a text longer than a bucket makes its bucket larger by itself; no rows give no files.  Columns stand in a
    struct, so that their names may clash with anything.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "shards")
    text = F.col("text").cast("string")
    row = F.struct(*[F.col(c) for c in docs.columns if c != ROW])
    rows = with_numbers(docs).select(F.xxhash64(F.lit(seed), "doc_id", text).alias("key"), F.col(ROW).alias("number"), _bytes(text).alias("n"), row.alias("row"))
    with intermediate(spark):
        keys = stored(rows.select("key", "number", "n"), "shard-keys")
        total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        buckets = max(1, -(-total // bucket_bytes))
        repeated = stored(keys.groupBy("key").count().where("count > 1").select("key"), "shard-repeats")
        n = repeated.count()
        bucket = F.pmod(F.xxhash64("key", "salt"), F.lit(buckets)).cast("int").alias("bucket")
        counts = _salted(keys, repeated, n).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
        first = _offsets(counts).withColumn("x", F.lit(None))
        scattered = _salted(rows, repeated, n).select(bucket, F.struct("key", "salt", "row").alias("x"))
        # a bucket's offset goes to its task as one more row
        both = scattered.unionByName(first, allowMissingColumns=True).repartitionById(buckets, F.col("bucket"))
        whole = both.groupBy("bucket").agg(F.collect_list("x").alias("xs"), F.max("first").alias("first"), F.max("total").alias("total"))
        order = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).when(a["salt"] < b["salt"], -1).when(a["salt"] > b["salt"], 1).otherwise(0)
        permuted = whole.select("first", "total", F.posexplode(F.shuffle(F.array_sort("xs", order), F.lit(seed))).alias("at", "x"))
        # the last shard that begins at or before the row; shard s begins at floor(s * total / shards)
        shard = F.expr(f"((first + at + 1) * {shards} - 1) div total").cast("int").alias("shard")
        out = permuted.select((F.col("first") + F.col("at")).alias("rank"), "total", shard, "x.row")
        out = out.select(F.expr(f"rank - (shard * total) div {shards}").cast("bigint").alias("slot"), "row", "shard")
        out.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    schema = StructType([StructField("slot", LongType()), StructField("row", out.schema["row"].dataType), StructField("shard", IntegerType())])
    return spark.read.schema(schema).parquet(folder)
