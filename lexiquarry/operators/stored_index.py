"""The inverted index on disk, changed in place of being rebuilt.

`upsert_index` and `delete_from_index` store a small segment: the changed
documents' term counts, the keys they replace, and how far document frequencies
move. They read the stored rows of these documents only, in the buckets of
their ids. `open_index` shows base and segments as one index, which keeps its
layout: a search opens the buckets of its terms. `merge_index` rewrites the
partitions that segments touch, and no others.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions.hashing import DOCUMENT_BUCKETS, document_bucket
from lexiquarry.operators.index import (
    KEY,
    TERM_BUCKETS,
    Index,
    analyze,
    count_terms,
    doc_stats,
    many,
    postings,
    term_bucket,
    term_stats,
)
from lexiquarry.session import lookup_side, settle
from lexiquarry.sources import versions as v

_DOC_TERMS = "doc_id string, doc_len bigint, terms array<struct<term:string,tf:bigint>>, shard_id int"
_POSTINGS = "term string, doc_id string, tf bigint, doc_len bigint, shard_id int"
_STATS = "term string, df bigint, shard_id int"
_PLAIN = ["shard_id", "term", "doc_id", "tf", "doc_len"]


def create_index(
    docs: DataFrame, root: str, stem: bool = True, buckets: int = TERM_BUCKETS, doc_buckets: int = DOCUMENT_BUCKETS
) -> Index:
    """Build the index of all documents under a new folder. Every text is analyzed once."""
    return store_counted(count_terms(analyze(docs, stem)), root, stem, buckets, doc_buckets)


def store_counted(
    counted: DataFrame, root: str, stem: bool, buckets: int = TERM_BUCKETS, doc_buckets: int = DOCUMENT_BUCKETS
) -> Index:
    """Store the index of documents whose terms are counted already."""
    spark = counted.sparkSession
    version = v.Version(0, settings={"stem": str(stem), "buckets": str(buckets), "doc_buckets": str(doc_buckets)})
    counted = counted.select(*KEY, "doc_len", "terms").withColumn("doc_bucket", document_bucket("doc_id", doc_buckets))
    version.parts.update(v.write_parts(counted, root, "doc_terms", "doc_bucket", ["doc_id"]))
    doc_terms = v.read_parts(spark, root, version, "doc_terms", _DOC_TERMS, "doc_bucket")
    entries = postings(doc_terms).withColumn("term_bucket", term_bucket(buckets))
    version.parts.update(v.write_parts(entries, root, "postings", "term_bucket", ["term", "doc_id"]))
    entries = v.read_parts(spark, root, version, "postings", _POSTINGS, "term_bucket")
    stats = entries.groupBy("shard_id", "term_bucket", "term").agg(F.count("*").alias("df"))
    version.parts.update(v.write_parts(stats, root, "term_stats", "term_bucket", ["term"]))
    v.publish(spark, root, version)
    return open_index(spark, root)


def _settings(version: v.Version) -> tuple[bool, int, int]:
    s = version.settings
    return s["stem"] == "True", int(s["buckets"]), int(s["doc_buckets"])


def _doc_terms(
    spark: SparkSession, root: str, version: v.Version, gone: DataFrame | None, only=None, keys: DataFrame | None = None
) -> DataFrame:
    """Term counts of all documents, or of those in some (shard, bucket) pairs or with some keys, with their doc_bucket."""
    _, _, doc_buckets = _settings(version)
    base = v.read_parts(spark, root, version, "doc_terms", _DOC_TERMS, "doc_bucket", only)
    late = v.read_segments(spark, root, version, "doc_terms", _DOC_TERMS)
    if late is not None:
        late = late.withColumn("doc_bucket", document_bucket("doc_id", doc_buckets))
        if only is not None:
            late = late.where(v.within(only, "doc_bucket"))
    return v.live(base, late, gone, keys)


def _postings(spark: SparkSession, root: str, version: v.Version, gone: DataFrame | None, only=None) -> DataFrame:
    """Postings, or those in some (shard, term bucket) pairs, with their term_bucket.

    Documents of segments are met with the replaced keys before their terms are
    spelled out, and so are all documents if the keys are many: single postings
    are only ever joined with few keys.
    """
    base = v.read_parts(spark, root, version, "postings", _POSTINGS, "term_bucket", only)
    if gone is None:
        return base
    if many(gone):
        return _spelled(_doc_terms(spark, root, version, gone), version, only).select(*base.columns)
    late = v.live_pieces(v.read_segments(spark, root, version, "doc_terms", _DOC_TERMS), gone)
    kept = base.join(gone.select(*KEY), KEY, "left_anti")
    return kept.unionByName(_spelled(late, version, only)).select(*base.columns)


def _spelled(doc_terms: DataFrame, version: v.Version, only=None) -> DataFrame:
    """Postings of documents with their term_bucket, or those of them in some (shard, term bucket) pairs."""
    _, buckets, _ = _settings(version)
    entries = postings(doc_terms).withColumn("term_bucket", term_bucket(buckets))
    return entries if only is None else entries.where(v.within(only, "term_bucket"))


def _term_stats(spark: SparkSession, root: str, version: v.Version, only=None) -> DataFrame:
    """Document frequencies; those of segments are added up."""
    _, buckets, _ = _settings(version)
    base = v.read_parts(spark, root, version, "term_stats", _STATS, "term_bucket", only)
    moved = v.read_segments(spark, root, version, "moved", _STATS)
    if moved is None:
        return base
    moved = moved.drop("segment").withColumn("term_bucket", term_bucket(buckets))
    if only is not None:
        moved = moved.where(v.within(only, "term_bucket"))
    both = base.unionByName(moved).groupBy("shard_id", "term_bucket", "term").agg(F.sum("df").alias("df"))
    return both.where("df > 0")


def open_index(spark: SparkSession, root: str, version: v.Version | None = None) -> Index:
    """The index as of a version, by default the last."""
    version = version or v.read_version(spark, root)
    gone = v.replaced(spark, root, version)
    doc_terms = _doc_terms(spark, root, version, gone).select("shard_id", "doc_id", "doc_len", "terms")
    return Index(
        _postings(spark, root, version, gone),
        _term_stats(spark, root, version).select("shard_id", "term", "df"),
        doc_stats(doc_terms),
        int(version.settings["buckets"]),
        doc_terms,
    )


def _old(spark: SparkSession, root: str, version: v.Version, keys: DataFrame) -> DataFrame:
    """What is stored of documents; only the buckets of their ids are opened."""
    _, _, doc_buckets = _settings(version)
    only = v.touched(keys.withColumn("doc_bucket", document_bucket("doc_id", doc_buckets)), "doc_bucket")
    gone = v.replaced(spark, root, version)
    return _doc_terms(spark, root, version, gone, only, keys)


def _moved(old: DataFrame, new: DataFrame | None) -> DataFrame:
    """By how much document frequencies change; terms that stay as frequent are there with zero."""
    changes = term_stats(postings(old)).withColumn("df", -F.col("df"))
    if new is not None:
        changes = changes.unionByName(term_stats(postings(new)))
    return changes.groupBy("shard_id", "term").agg(F.sum("df").alias("df"))


def upsert_index(spark: SparkSession, root: str, changed: DataFrame, **settings: str) -> v.Version:
    """Replace the entries of changed documents and add those of new ones; each document is there once.

    `settings` are recorded with the version.
    """
    version = v.read_version(spark, root)
    stem, _, _ = _settings(version)
    name, folder = v.new_segment(root)
    v.write_segment(count_terms(analyze(changed, stem)), folder, "doc_terms")
    new = spark.read.schema(_DOC_TERMS).parquet(f"{folder}/doc_terms")
    keys = lookup_side(new.select(*KEY))
    v.write_segment(keys, folder, "gone")
    v.write_segment(_moved(_old(spark, root, version, keys), new), folder, "moved")
    return v.publish(spark, root, version.with_segment(name, **settings))


def delete_from_index(spark: SparkSession, root: str, ids: DataFrame, **settings: str) -> v.Version:
    """Take documents out of the index; unknown ids change nothing."""
    version = v.read_version(spark, root)
    name, folder = v.new_segment(root)
    old = settle(_old(spark, root, version, lookup_side(ids.select(*KEY).distinct())), "old")
    v.write_segment(old.select(*KEY), folder, "gone")
    v.write_segment(old.limit(0).select("shard_id", "doc_id", "doc_len", "terms"), folder, "doc_terms")
    v.write_segment(_moved(old, None), folder, "moved")
    return v.publish(spark, root, version.with_segment(name, **settings))


def reindex_stored(spark: SparkSession, root: str, docs: DataFrame) -> v.Version:
    """Index every document again and merge; entries of documents no longer in the table stay."""
    upsert_index(spark, root, docs)
    return merge_index(spark, root)


def merge_index(spark: SparkSession, root: str) -> v.Version:
    """Write the partitions that segments touch anew, with the segments in them; others stay as they are."""
    version = v.read_version(spark, root)
    if not version.segments:
        return version
    _, buckets, doc_buckets = _settings(version)
    gone = v.replaced(spark, root, version)
    by_id = v.touched(gone.withColumn("doc_bucket", document_bucket("doc_id", doc_buckets)), "doc_bucket")
    moved = v.read_segments(spark, root, version, "moved", _STATS)
    by_term = v.touched(moved.withColumn("term_bucket", term_bucket(buckets)), "term_bucket")
    old = {
        (table, s, b): gen
        for (table, s, b), gen in version.parts.items()
        if (s, b) not in (by_id if table == "doc_terms" else by_term)
    }
    written = {}
    for own in v.by_shard(by_id):
        written |= v.write_parts(_doc_terms(spark, root, version, gone, own), root, "doc_terms", "doc_bucket", ["doc_id"])
    # What was just written holds every document that counts; with many keys nothing is joined again.
    merged, by_document = replace(version, parts={**old, **written}, segments=()), many(gone)
    for own in v.by_shard(by_term):
        if by_document:
            shards = {s for s, _ in own}
            docs = {(s, b) for (table, s, b) in merged.parts if table == "doc_terms" and s in shards}
            entries = _spelled(_doc_terms(spark, root, merged, None, docs), version, own)
        else:
            entries = _postings(spark, root, version, gone, own)
        entries = entries.select(*_PLAIN, "term_bucket")
        written |= v.write_parts(entries, root, "postings", "term_bucket", ["term", "doc_id"])
    written |= v.write_parts(_term_stats(spark, root, version, by_term), root, "term_stats", "term_bucket", ["term"])
    return v.publish(spark, root, replace(version, number=version.number + 1, parts={**old, **written}, segments=()))


def shard_bytes(spark: SparkSession, root: str, version: v.Version | None = None) -> DataFrame:
    """Stored bytes of a version per shard; reads file lengths only.

    Segments are counted whole under a null shard, for their tables are not split by it.
    """
    version = version or v.read_version(spark, root)
    folders = [
        f"{root}/{table}/shard_id={s}/{'doc' if table == 'doc_terms' else 'term'}_bucket={b}/gen={gen}"
        for (table, s, b), gen in version.parts.items()
    ] + [f"{root}/segments/{name}/*" for name in version.segments]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders)
    shard = F.regexp_extract("path", r"/shard_id=(-?\d+)/", 1)
    shard = F.when(shard != "", shard).cast("int")
    return files.groupBy(shard.alias("shard_id")).agg(F.sum("length").alias("index_size_bytes"))
