"""Deterministic identities, revisions and canonical text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_id(source: Column | str, dataset: Column | str, natural_key: Column | str, version: Column | str) -> Column:
    """SHA-256 of the compact JSON array of the four strings."""
    return F.sha2(F.to_json(F.array(*(_c(c).cast("string") for c in (source, dataset, natural_key, version)))), 256)


def canonical_json(*columns: str, **named: Column) -> Column:
    """JSON object with sorted keys, nulls kept."""
    fields = {**{c: F.col(c) for c in columns}, **named}
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def iso_ms(ts: Column | str) -> Column:
    return F.date_format(_c(ts), ISO)


def dimension_key(timestamp: Column | str, *dimensions: str) -> Column:
    """Sorted JSON of a record's time and dimensions."""
    return canonical_json(*dimensions, timestamp=iso_ms(timestamp))


def revisioned_key(key: Column | str, payload: Column | str) -> Column:
    """The key with its payload's digest: an equal payload is the same revision, a changed one another."""
    return F.concat_ws(":", _c(key), F.sha2(_c(payload), 256))


def row_version(ts: Column | str, identity: Column | str) -> Column:
    """Milliseconds times 2^20 plus the first 20 bits of the identity's digest."""
    return F.unix_millis(_c(ts)) * F.lit(1048576) + F.conv(F.substring(F.sha2(_c(identity).cast("string"), 256), 1, 5), 16, 10).cast("bigint")


def truncate_ms(ts: Column | str) -> Column:
    """Milliseconds, cut off and not rounded."""
    return F.date_trunc("MILLISECOND", _c(ts))
