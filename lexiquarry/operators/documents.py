"""The document table: lookups, upserts, deletes and per-shard counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.operators.ranking import first_per_key
from lexiquarry.session import lookup_side, settle

KEY = ["shard_id", "doc_id"]
FIELDS = ["title", "content", "source", "metadata"]
NOT_FOUND = "Document not found"


def get_document(docs: DataFrame, doc_id: str, shard_id: int | None = None) -> DataFrame:
    """The document with this id, whole; no row when there is none."""
    found = docs.where(F.col("doc_id") == doc_id)
    return found if shard_id is None else found.where(F.col("shard_id") == shard_id)


def fetch_documents(docs: DataFrame, ids: DataFrame, shard_id: int | None = None) -> DataFrame:
    """Documents whose id is in the list, of one shard or of all."""
    if shard_id is not None:
        docs = docs.where(F.col("shard_id") == shard_id)
    return docs.join(lookup_side(ids.select("doc_id")), "doc_id", "left_semi")


def latest_versions(incoming: DataFrame, order: str = "seq") -> DataFrame:
    """The last version of each document of a batch; of equally late ones the one whose content hash is highest."""
    content = F.xxhash64("content", "title", "source", F.to_json(F.struct("metadata")))
    return first_per_key(incoming, KEY, [F.desc(order), F.desc(content), F.desc("content")])


def upsert_documents(
    current: DataFrame, incoming: DataFrame, now: Column, order: str = "seq"
) -> DataFrame:
    """The document table after the batch, with `status` per row.

    Known documents get the new fields and `updated_at`, keep `created_at` and
    are "updated"; new ones are "indexed"; all others are "unchanged". The
    current table is only scanned when the batch is small enough to broadcast;
    its wide rows are never shuffled for an outer join.
    """
    latest = settle(latest_versions(incoming, order).select(*KEY, *FIELDS))
    keys = latest.select(*KEY)
    known = current.join(keys, KEY, "left_semi").select(*KEY, F.col("created_at").alias("_since"))
    written = latest.join(known, KEY, "left").select(
        *KEY,
        *FIELDS,
        F.coalesce("_since", now).alias("created_at"),
        now.alias("updated_at"),
        F.when(F.col("_since").isNull(), "indexed").otherwise("updated").alias("status"),
    )
    kept = current.join(keys, KEY, "left_anti").select(
        *KEY, *FIELDS, "created_at", "updated_at", F.lit("unchanged").alias("status")
    )
    return kept.unionByName(written)


def upsert_results(current: DataFrame, incoming: DataFrame, order: str = "seq") -> DataFrame:
    """Status of every request of a batch, as if they ran one after the other."""
    first = settle(incoming.groupBy(*KEY).agg(F.min(order).alias("_first")))
    known = current.join(first, KEY, "left_semi").select(*KEY, F.lit(True).alias("_known"))
    status = first.join(known, KEY, "left")
    new = F.col("_known").isNull() & (F.col(order) == F.col("_first"))
    return incoming.join(lookup_side(status), KEY).select(
        *KEY, order, F.when(new, "indexed").otherwise("updated").alias("status")
    )


def delete_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The table without the listed documents."""
    return docs.join(lookup_side(ids.select(*KEY)), KEY, "left_anti")


def delete_results(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Per listed id "deleted", or an error when there is no such document."""
    asked = lookup_side(ids.select(*KEY))
    found = docs.join(asked, KEY, "left_semi").select(*KEY, F.lit(True).alias("_found"))
    return asked.join(found, KEY, "left").select(
        *KEY,
        F.when(F.col("_found"), "deleted").otherwise("").alias("status"),
        F.when(F.col("_found"), "").otherwise(NOT_FOUND).alias("error"),
    )


def document_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("shard_id").agg(
        F.count("*").alias("document_count"), F.max("updated_at").alias("last_updated")
    )


def seed_shards(meta: DataFrame, shards: int) -> DataFrame:
    """Shard rows with a zero count added for the shards that have none."""
    wanted = meta.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard_id"))
    # `wanted` has one row per shard number, a handful by construction.
    known = F.broadcast(meta.select("shard_id").distinct())
    missing = wanted.join(known, "shard_id", "left_anti").select(
        "shard_id",
        F.lit(0).cast("bigint").alias("document_count"),
        F.lit(None).cast("timestamp").alias("last_updated"),
        F.lit("active").alias("status"),
    )
    return meta.select(*missing.columns).unionByName(missing)


def shard_metadata(docs: DataFrame, shards: int) -> DataFrame:
    """Counts per shard, with empty shards shown as zero."""
    counts = document_counts(docs).withColumn("status", F.lit("active"))
    return seed_shards(counts, shards)
