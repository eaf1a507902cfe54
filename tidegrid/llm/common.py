"""Session helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

_ROOT = str(Path(__file__).resolve().parents[2])


#: Rows that go to a Python worker at a time, unless the session says otherwise: whole texts are large, and a batch is held
#: several times over, in the executor and in the worker.
_BATCH_CONF, _BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import the kernels by name, so this checkout must be on their path; batches are kept small."""
    if spark.conf.get(_BATCH_CONF, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if _ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, have)])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local one if it is unset and all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file:" + os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_open = threading.local()


def _levels() -> list[list[str]]:
    if not hasattr(_open, "levels"):
        _open.levels = []
    return _open.levels


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``stored`` inside go at the end; what is given out is ``returned``, or read from neither."""
    levels = _levels()
    levels.append([])
    try:
        yield
    finally:
        for path in levels.pop():
            remove(spark, path)


def _written(df: DataFrame, name: str, up: int) -> DataFrame:
    spark, levels = df.sparkSession, _levels()
    path = scratch(spark, name)
    if len(levels) >= up:
        levels[-up].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it was running, not the stages before.
    """
    return _written(df, name, 1)


def returned(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for the caller of an ``intermediate`` part: it stays until the caller's own part ends."""
    return _written(df, name, 2)


def with_row_id(df: DataFrame, name: str = "uid") -> DataFrame:
    """Number the rows; store the result before joining on the number."""
    return df.withColumn(name, F.monotonically_increasing_id())


#: The column of a row's number that goes along with the rows.
ROW = "__row"
_SLOTS, _PLACES = 1 << 31, 1 << 32


def with_numbers(docs: DataFrame) -> DataFrame:
    """All columns and ROW, a number that every read gives the same row.

    Splits follow the number of cores there are at the time, so counting rows by partition would number them otherwise in
    the next scan.  Rows that come straight from Parquet files are numbered by their file's hash and their place in it, if
    each place is there once (by count, sum and sum of squares) and the files' hashes differ; all others are stored with a
    number.
    """
    if ROW in docs.columns:
        return docs
    slot, place = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(_SLOTS)), F.col("_metadata.row_index")
    try:
        there = docs.select(F.col("_metadata.file_path").alias("file"), slot.alias("slot"), place.alias("i"))
    except AnalysisException:
        return stored(with_row_id(docs, ROW), "numbered")
    n, wide = F.col("n").cast("decimal(20,0)"), F.col("i").cast("decimal(20,0)")
    files = there.groupBy("file", "slot").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("most"), F.sum(wide).alias("s"), F.sum((wide * wide).cast("decimal(28,0)")).alias("q"))
    whole = (F.col("most") == F.col("n") - 1) & (2 * F.col("s") == n * (n - 1)) & (6 * F.col("q") == (n * (n - 1)).cast("decimal(26,0)") * (2 * n - 1).cast("decimal(12,0)"))
    found = files.agg(F.count(F.lit(1)).alias("files"), F.countDistinct("slot").alias("slots"), F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.coalesce(F.min(whole.cast("int")), F.lit(1)).alias("whole")).first()
    if found["files"] != found["slots"] or found["n"] >= _PLACES or not found["whole"]:
        return stored(with_row_id(docs, ROW), "numbered")
    return docs.withColumn(ROW, slot * F.lit(_PLACES) + place)


def numbered(docs: DataFrame) -> DataFrame:
    """uid, doc_id and text of each row; see ``with_numbers``."""
    docs = docs if ROW in docs.columns else docs.select("doc_id", "text")
    return with_numbers(docs).select(F.col(ROW).alias("uid"), "doc_id", F.col("text").cast("string").alias("text"))


def require_integer(docs: DataFrame, column: str = "doc_id") -> None:
    kind = docs.schema[column].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{column} must be an integer, not {kind}")


#: Row numbers that are sent to every executor, some 25 MB; more of them are joined by a shuffle.
BROADCAST_ROWS = 1 << 19


def by_number(rows: DataFrame, numbers: DataFrame, on: str, how: str) -> DataFrame:
    """Semi or anti join of ``rows`` with the stored table ``numbers`` of one narrow column, counted before it is broadcast."""
    return rows.join(F.broadcast(numbers) if numbers.count() <= BROADCAST_ROWS else numbers.hint("merge"), on, how)


def with_kernel(df: DataFrame, run, made: dict[str, tuple[str, DataType]]) -> DataFrame:
    """Apply a kernel to all columns under plain names, since those of the input may clash or repeat."""
    from .textops import tidy

    workers_find_package(df.sparkSession)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    schema = StructType([*plain.schema, *(StructField(own, kind) for own, (_, kind) in made.items())])
    return plain.mapInArrow(tidy(run), schema).toDF(*df.columns, *(name for name, _ in made.values()))


#: Bytes of a table's files that one of the parts is made for to which an operator deals its hashes.
PART_BYTES = 16 << 20


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a DataFrame, from the file listing alone; 0 if there are none."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for f in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def partitions_for(docs: DataFrame) -> int:
    """So many parts that each stays about as large whatever the input, two times ``spark.sql.shuffle.partitions`` at least."""
    return max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stored_bytes(docs) // PART_BYTES))
