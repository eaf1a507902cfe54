"""WARC archives: a deterministic sharded writer and a reader.

Records are dealt to shards by ranges of page_id, sorted in each shard, and written to files that roll over at a
compressed size.  Which range goes where follows from exact histograms of payload bytes, refined where a range is heavy, and not
from a sample, so the same pages give the same files, byte for byte, whatever the cluster.  A task writes under a temporary name and
renames; a file that a lost task has left whole is kept.  The manifest is written last, into the archive, under a
temporary name too: a reader needs the folder only, and a file counts only if the manifest names it.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_number, remove, scratch, workers_find_package

#: Ranges of page_id in the first histogram, ranges that each heavy one is cut into again, and the most tasks that write.
BUCKETS, FINER, TASKS = 4096, 256, 1 << 16
_NULL = (1 << 63) - 1
MIN_REVISIT = 100
_DATE = "2000-01-01T00:00:00Z"
#: Where files are until they are whole; it goes once the manifest is written.
_TEMPORARY = "_temporary"
_LIST = "manifest"


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _record_id(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page}|{digest}'.encode()).digest()[:16])}>"


def _line(name: str, value: str | None) -> bytes:
    return b"" if value is None else f"{name}: ".encode() + value.replace("\r", "%0D").replace("\n", "%0A").encode() + b"\r\n"


def _record(page: str | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers: str | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = b"WARC/1.1\r\n" + _line("WARC-Type", "revisit" if revisit else "response") + _line("WARC-Record-ID", _record_id(page, digest))
    head += _line("WARC-Date", _DATE) + _line("WARC-Target-URI", url) + _line("X-Page-Id", page) + _line("WARC-Payload-Digest", f"sha256:{digest}")
    head += _line("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")
    if revisit:
        head += _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head += _line("WARC-Refers-To", _record_id(refers, digest)) + _line("X-Refers-To-Page-Id", refers)
    head += b"Content-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block)
    return head + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _same(disk: fs.FileSystem, path: str, digest: str) -> bool:
    with disk.open_input_stream(path, compression=None) as f:
        return hashlib.sha256(f.read()).hexdigest() == digest


_MANIFEST = "file string, shard bigint, part int, records bigint, bytes bigint, sha256 string, first_page string, last_page string"


def _writer(folder: str, roll: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = _filesystem(folder)
        disk.create_dir(f"{top}/{_TEMPORARY}", recursive=True)
        shard, part, body, n, size, first, last = None, 0, [], 0, 0, None, None
        revisits: tuple = (None, None)
        rows = []

        def close() -> None:
            nonlocal body, n, size, part
            if not n:
                return
            name, data = f"pages-{shard:06d}-{part:04d}.warc.gz", b"".join(body)
            temporary = f"{top}/{_TEMPORARY}/{name}.{uuid.uuid4().hex}"
            with disk.open_output_stream(temporary, compression=None) as f:
                f.write(data)
            digest, there = hashlib.sha256(data).hexdigest(), disk.get_file_info(f"{top}/{name}")
            if there.type != fs.FileType.NotFound and there.size == len(data) and _same(disk, f"{top}/{name}", digest):
                disk.delete_file(temporary)  # a task that was tried before has left it whole
            else:
                if there.type != fs.FileType.NotFound:  # not all file systems rename onto a file
                    disk.delete_file(f"{top}/{name}")
                disk.move(temporary, f"{top}/{name}")
            rows.append((name, shard, part, n, len(data), digest, first, last))
            body, n, size, part = [], 0, 0, part + 1

        for batch in batches:
            for i in range(batch.num_rows):
                s, page, url, digest, kind, refers, html = (c[i].as_py() for c in batch.columns)
                if not kind:
                    revisits = (page, digest), refers
                    continue
                if s != shard:
                    close()
                    shard, part = s, 0
                again = revisits[0] == (page, digest)
                member = _gzip(_record(page, url, (html or "").encode(), digest, again, revisits[1] if again else None), level)
                first = page if not n else first
                body.append(member)
                n, size, last = n + 1, size + len(member), page
                if size >= roll:
                    close()
        close()
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=re.findall(r"(\w+) \w+(?:,|$)", _MANIFEST))

    return run


def _shards(lengths: DataFrame, shard_bytes: int) -> tuple[DataFrame, int, int, int]:
    """(bucket, base, cuts): the shards before each bucket of page_ids, and the (page_id, digest) at which others begin in it.

    Also the least page_id, the buckets' width and the number of shards.  Rows of a bucket that is over ``shard_bytes`` are counted again
    by finer ranges, down to a single page_id, which is cut by digests; each count brings BUCKETS rows, or FINER for each heavy range.
    """
    spark = lengths.sparkSession
    lo, hi = (x or 0 for x in lengths.agg(F.min("page_id"), F.max("page_id")).first())
    # powers of two, so that finer ranges lie in coarser ones
    width = wide = 1 << max(0, -(-(hi - lo + 1) // BUCKETS) - 1).bit_length()
    start = lambda w: F.lit(lo) + F.expr(f"(page_id - ({lo})) div {w}") * F.lit(w)

    def counted(rows: DataFrame, width: int) -> dict[int, int]:
        found = rows.groupBy(start(width).alias("start")).agg(F.sum(F.col("n") + 512).alias("n")).collect()
        return {_NULL if r["start"] is None else r["start"]: r["n"] for r in found}

    sizes = counted(lengths, width)
    heavy = [s for s, n in sizes.items() if n > shard_bytes and s != _NULL]
    while heavy and width > 1:
        inside = F.broadcast(spark.createDataFrame([(s,) for s in heavy], "start bigint"))
        rows = lengths.withColumn("start", start(width)).join(inside, "start", "left_semi").drop("start")
        width = max(1, width // FINER)
        more = counted(rows, width)
        sizes = {s: n for s, n in sizes.items() if s not in set(heavy)} | more
        heavy = [s for s, n in more.items() if n > shard_bytes]
    cuts: list[tuple[int, int]] = []
    filled = 0
    for begin in sorted(sizes):
        n = sizes[begin]
        if filled and filled + n > shard_bytes:
            cuts.append((begin, 0))
            filled = 0
        parts = -(-n // shard_bytes)
        cuts += [(begin, j * 65536 // parts) for j in range(1, parts)]
        filled = shard_bytes if parts > 1 else filled + n
    table: dict[int, tuple[int, list]] = {}
    base, k = 0, 0
    for b in range(BUCKETS + 1):
        end = _NULL if b == BUCKETS - 1 else lo + (b + 1) * wide
        own = []
        while k < len(cuts) and (cuts[k][0] < end or b == BUCKETS):
            own.append(cuts[k])
            k += 1
        table[b] = (base, own)
        base += len(own)
    return spark.createDataFrame([(b, n, own) for b, (n, own) in table.items()], "bucket int, base int, cuts array<struct<page:bigint,d:int>>"), lo, wide, len(cuts) + 1


def write_warc(pages: DataFrame, folder: str | None = None, *, shard_bytes: int = 32 << 20, roll_bytes: int = 8 << 20, level: int = 4, min_revisit: int = MIN_REVISIT) -> str:
    """Write a record per row of ``pages`` (page_id, url, html) and return the folder, which holds the files and their manifest.

    Of rows with equal payloads of at least ``min_revisit`` bytes, those with the smallest page_id are responses and the
    others revisit it.  ``shard_bytes`` is the payload of a shard, and so of a range of page_ids; ``roll_bytes`` the compressed
    size at which a file of it ends.  A task writes one shard, or several if there are over TASKS.  A null html is an empty
    payload, a null url gives no target URI, a null page_id sorts last and gives no page id; a page_id whose rows are too large for a
    shard is cut by digests; repeated rows are written as often as they come; other columns are not read.  No pages
    give no files, but a manifest.
    """
    spark = pages.sparkSession
    workers_find_package(spark)
    folder = folder or scratch(spark, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    lengths = rows.select("page_id", "digest", F.octet_length("html").cast("bigint").alias("n"))
    table, lo, width, shards = _shards(lengths.select("page_id", "n"), shard_bytes)
    first = lengths.where(F.col("n") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("to"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("digest", "to")
    again = lengths.where(F.col("n") >= min_revisit).join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("to"))).select("page_id", "digest", "to").distinct()
    null = lambda kind: F.lit(None).cast(kind)
    both = again.select("page_id", null("string").alias("url"), "digest", F.lit(0).alias("kind"), F.col("to").cast("string").alias("refers"), null("string").alias("html")).unionByName(
        rows.select("page_id", "url", "digest", F.lit(1).alias("kind"), null("string").alias("refers"), "html")
    )
    bucket = F.coalesce(F.expr(f"(page_id - ({lo})) div {width}"), F.lit(BUCKETS)).cast("int")
    here = F.struct(F.coalesce("page_id", F.lit(_NULL)).alias("page"), F.conv(F.substring("digest", 1, 4), 16, 10).cast("int").alias("d"))
    shard = (F.col("base") + F.size(F.filter("cuts", lambda c: c <= here))).cast("bigint")
    placed = both.withColumn("bucket", bucket).join(F.broadcast(table), "bucket").withColumn("shard", shard)  # BUCKETS rows
    each = -(-shards // TASKS)
    dealt = placed.repartitionById(-(-shards // each), F.floor(F.col("shard") / each).cast("int")).sortWithinPartitions("shard", F.asc_nulls_last("page_id"), "digest", "kind", "url")
    sent = dealt.select("shard", F.col("page_id").cast("string").alias("page_id"), "url", "digest", "kind", "refers", "html")
    sent.mapInArrow(_writer(folder, roll_bytes, level), _MANIFEST).write.mode("overwrite").parquet(f"{folder}/{_TEMPORARY}/{_LIST}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    disk = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    disk.delete(path(f"{folder}/{_LIST}"), True)
    if not disk.rename(path(f"{folder}/{_TEMPORARY}/{_LIST}"), path(f"{folder}/{_LIST}")):
        raise OSError(f"the manifest of {folder} can't be put in its place")
    remove(spark, f"{folder}/{_TEMPORARY}")
    return folder


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/{_LIST}")


def _headers(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode(errors="replace").split("\r\n")[1:])}


def _members(data: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(data):
        z = zlib.decompressobj(31)
        out = z.decompress(data[at : at + (1 << 20)])
        used = min(len(data), at + (1 << 20))
        pieces = [out]
        while not z.eof:
            if used >= len(data):
                raise ValueError("a gzip member is cut off")
            pieces.append(z.decompress(data[used : used + (1 << 20)]))
            used = min(len(data), used + (1 << 20))
        yield at, b"".join(pieces)
        at = used - len(z.unused_data)


_RECORD = "page_id string, target_uri string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, warc_file string, warc_offset bigint"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
    names = re.findall(r"(\w+) \w+(?:,|$)", _RECORD)
    for batch in batches:
        for i in range(batch.num_rows):
            name, data, rows = batch.column(0)[i].as_py().rsplit("/", 1)[-1], batch.column(1)[i].as_py(), []
            for at, member in _members(data):
                head, _, rest = member.partition(b"\r\n\r\n")
                h = _headers(head)
                block = rest[: int(h["content-length"])]
                if hashlib.sha256(block).hexdigest() != h["warc-block-digest"].removeprefix("sha256:"):
                    raise ValueError(f"{name}: the block at {at} differs from its digest")
                http, _, payload = block.partition(b"\r\n\r\n")
                digest, length = h["warc-payload-digest"].removeprefix("sha256:"), int(_headers(http)["content-length"])
                if h["warc-type"] == "response":
                    digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
                rows.append((h.get("x-page-id"), h.get("warc-target-uri"), length, digest, h["warc-type"], h.get("x-refers-to-page-id"), name, at))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 8, types, strict=True)], names=names)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the files that the folder's manifest names: page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to, file and offset.

    Digests are computed anew from the payloads of responses; those of revisits are in their headers.
    """
    workers_find_package(spark)
    manifest = read_manifest(spark, folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], _RECORD)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "content")
    return by_number(files, manifest.select("file").distinct(), "file", "left_semi").select("path", "content").mapInArrow(_reader, _RECORD)
