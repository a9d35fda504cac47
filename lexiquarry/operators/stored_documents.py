"""The document table on disk, changed by small batches.

A batch reads of the stored rows only the buckets of its ids, and of these only
keys and times; it is stored as a segment with the rows it writes and the keys
it replaces. `merge_documents` rewrites the (shard, bucket) partitions that
segments touch. All other files stay as they are.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiquarry.functions.hashing import document_bucket
from lexiquarry.operators.documents import FIELDS, KEY, NOT_FOUND, latest_versions
from lexiquarry.session import lookup_side, settle
from lexiquarry.sources import versions as v

BUCKET = "doc_bucket"
_TIMES = ["created_at", "updated_at"]


def create_documents(docs: DataFrame, root: str) -> DataFrame:
    """Store a document table under a new folder; keys are unique. `status` says what the last write of a document did."""
    spark = docs.sparkSession
    status = F.col("status") if "status" in docs.columns else F.lit("indexed").alias("status")
    rows = docs.select(*KEY, *FIELDS, *_TIMES, status)
    version = v.Version(0, settings={"schema": rows.schema.json()})
    version.parts.update(v.write_parts(rows.withColumn(BUCKET, document_bucket()), root, "documents", BUCKET, ["doc_id"]))
    v.publish(spark, root, version)
    return open_documents(spark, root)


def _schema(version: v.Version) -> T.StructType:
    return T.StructType.fromJson(json.loads(version.settings["schema"]))


def _rows(spark: SparkSession, root: str, version: v.Version, only=None, keys: DataFrame | None = None) -> DataFrame:
    schema = _schema(version)
    base = v.read_parts(spark, root, version, "documents", schema, BUCKET, only)
    late = v.read_segments(spark, root, version, "documents", schema)
    if late is not None:
        late = late.withColumn(BUCKET, document_bucket())
        if only is not None:
            late = late.where(v.within(only, BUCKET))
    return v.live(base, late, v.replaced(spark, root, version), keys).select(*KEY, *FIELDS, *_TIMES, "status", BUCKET)


def open_documents(spark: SparkSession, root: str, version: v.Version | None = None) -> DataFrame:
    """The table as of a version, by default the last; `doc_bucket` lets lookups open the buckets of their ids only."""
    return _rows(spark, root, version or v.read_version(spark, root))


def _stored(spark: SparkSession, root: str, version: v.Version, keys: DataFrame) -> DataFrame:
    """The stored rows of these keys; other buckets are not opened."""
    only = v.touched(keys.withColumn(BUCKET, document_bucket()), BUCKET)
    return _rows(spark, root, version, only, keys)


def upsert_documents(
    spark: SparkSession, root: str, incoming: DataFrame, now: Column, order: str = "seq", **settings: str
) -> DataFrame:
    """Store a batch and return (shard_id, doc_id, status) of its documents.

    Known documents get the new fields and `updated_at`, keep `created_at` and
    are "updated"; new ones are "indexed". Of several versions of a document in
    the batch the last by `order` counts. `settings` are recorded with the version.
    """
    return upsert_latest(spark, root, settle(latest_versions(incoming, order).select(*KEY, *FIELDS), "batch"), now, **settings)


def upsert_latest(spark: SparkSession, root: str, latest: DataFrame, now: Column, **settings: str) -> DataFrame:
    """As `upsert_documents`, for a stored batch in which each document is there once already."""
    version = v.read_version(spark, root)
    keys = lookup_side(latest.select(*KEY))
    known = _stored(spark, root, version, keys).select(*KEY, F.col("created_at").alias("_since"), F.lit(True).alias("_known"))
    known = settle(known, "known")
    name, folder = v.new_segment(root)
    status = F.when(F.col("_known"), "updated").otherwise("indexed").alias("status")
    written = latest.join(known, KEY, "left").select(
        *KEY, *FIELDS, F.coalesce("_since", now).alias("created_at"), now.alias("updated_at"), status
    )
    types = {f.name: f.dataType for f in _schema(version).fields}
    v.write_segment(written.select(*(F.col(c).cast(types[c]) for c in written.columns)), folder, "documents")
    v.write_segment(keys, folder, "gone")
    v.publish(spark, root, version.with_segment(name, **settings))
    return spark.read.schema(_schema(version)).parquet(f"{folder}/documents").select(*KEY, "status")


def delete_documents(spark: SparkSession, root: str, ids: DataFrame, **settings: str) -> DataFrame:
    """Take documents out of the table and return (shard_id, doc_id, status, error) of every id asked for."""
    version = v.read_version(spark, root)
    asked = settle(ids.select(*KEY).distinct(), "asked")
    found = settle(_stored(spark, root, version, asked).select(*KEY), "found")
    name, folder = v.new_segment(root)
    v.write_segment(found, folder, "gone")
    v.write_segment(spark.createDataFrame([], _schema(version)), folder, "documents")
    v.publish(spark, root, version.with_segment(name, **settings))
    return asked.join(found.withColumn("_found", F.lit(True)), KEY, "left").select(
        *KEY,
        F.when(F.col("_found"), "deleted").otherwise("").alias("status"),
        F.when(F.col("_found"), "").otherwise(NOT_FOUND).alias("error"),
    )


def merge_documents(spark: SparkSession, root: str) -> v.Version:
    """Write the partitions that segments touch anew; others stay as they are."""
    version = v.read_version(spark, root)
    if not version.segments:
        return version
    gone = v.replaced(spark, root, version)
    only = v.touched(gone.withColumn(BUCKET, document_bucket()), BUCKET)
    written = {}
    for own in v.by_shard(only):
        written |= v.write_parts(_rows(spark, root, version, own), root, "documents", BUCKET, ["doc_id"])
    old = {part: gen for part, gen in version.parts.items() if part[1:] not in only}
    return v.publish(spark, root, replace(version, number=version.number + 1, parts={**old, **written}, segments=()))


def changes(spark: SparkSession, root: str, since: int, until: int | None = None) -> DataFrame:
    """Versions of documents that went (`change` -1) and came (1) between two versions of the table.

    A document that is there in both, changed, gives a row of each. Only
    buckets of changed ids are opened. Segments tell what has changed, so no
    merge may lie between the two.
    """
    old = v.read_version(spark, root, since)
    new = v.read_version(spark, root, until)
    if new.segments[: len(old.segments)] != old.segments or new.parts != old.parts:
        raise ValueError(f"the table was merged between versions {old.number} and {new.number}")
    fresh = replace(new, segments=new.segments[len(old.segments) :])
    gone = v.read_segments(spark, root, fresh, "gone", v.GONE)
    if gone is None:
        return _rows(spark, root, old).drop(BUCKET).withColumn("change", F.lit(0)).limit(0)
    keys = lookup_side(gone.select(*KEY).distinct())
    went, came = _stored(spark, root, old, keys), _stored(spark, root, new, keys)
    both = went.withColumn("change", F.lit(-1)).unionByName(came.withColumn("change", F.lit(1)))
    return both.drop(BUCKET)
