"""Deterministic ids and shards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many shards documents and terms are spread over.
DOCUMENT_SHARDS = 3
TERM_SHARDS = 2

# Directories the documents of a shard are stored in, by a hash of the id.
DOCUMENT_BUCKETS = 16


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def shard_of(key, shards: int) -> Column:
    """First eight hex digits of the md5 of the key, modulo the shard count.

    The same in every process and engine, so writers and readers agree.
    """
    digits = F.substring(F.md5(_col(key)), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % shards).cast("int")


def document_bucket(doc_id="doc_id", buckets: int = DOCUMENT_BUCKETS) -> Column:
    """Directory of a shard that a stored document is in."""
    return F.pmod(F.xxhash64(_col(doc_id)), F.lit(buckets)).cast("int")


def content_id(doc_id, content) -> Column:
    """The given id, or the md5 of the content where it is absent or empty."""
    return F.coalesce(F.nullif(_col(doc_id), F.lit("")), F.md5(_col(content)))
