"""Keep the document table and the index in step with a stream of documents.

Both are stored tables that change by segments: a micro-batch reads the buckets
of its ids and appends one segment to each; every `merge_after` batches the
partitions that segments touch are rewritten into the searchable layout. What
is not merged yet is read beside it, so reading never costs the whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexiquarry.operators import stored_documents, stored_index
from lexiquarry.operators.documents import FIELDS, KEY, latest_versions
from lexiquarry.operators.index import Index
from lexiquarry.session import passing, settle
from lexiquarry.sources import versions as v
from lexiquarry.streaming import log

MERGE_AFTER = 8


def _folders(out: str) -> tuple[str, str]:
    return f"{out}/documents", f"{out}/index"


def _ensure(docs: DataFrame, out: str, stem: bool) -> None:
    """Make empty tables if there are none."""
    spark, (documents, index) = docs.sparkSession, _folders(out)
    if not v.versions(spark, documents):
        times = [T.StructField(name, T.TimestampType()) for name in ("created_at", "updated_at")]
        schema = T.StructType([*(docs.schema[c] for c in (*KEY, *FIELDS)), *times])
        empty = spark.createDataFrame([], schema)
        stored_documents.create_documents(empty, documents)
    if not v.versions(spark, index):
        stored_index.create_index(spark.createDataFrame([], "shard_id int, doc_id string, title string, content string"), index, stem)


def index_stream(
    docs: DataFrame,
    out: str,
    checkpoint: str,
    now: Column,
    order: str = "seq",
    stem: bool = True,
    every: str | None = None,
    merge_after: int = MERGE_AFTER,
    keep: int | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch of documents into the table and index under `out`.

    A batch that is replayed after a failure changes nothing it has already
    changed. `order` tells versions of one document within a batch apart.
    With `keep`, a merge deletes what only versions before the last `keep` read,
    so that the tables do not grow with their history; by default all stay.
    """
    _ensure(docs, out, stem)
    documents, index = _folders(out)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = {v.batch_name(checkpoint): str(number)}
        with passing(spark):
            rows = settle(latest_versions(batch, order), "batch")
            if not v.has_batch(v.read_version(spark, documents), checkpoint, number):
                stored_documents.upsert_latest(spark, documents, rows, now, **done)
            version = v.read_version(spark, index)
            if not v.has_batch(version, checkpoint, number):
                version = stored_index.upsert_index(spark, index, rows, **done)
            else:
                version = None
        if version and len(version.segments) >= merge_after:
            merge(spark, out, keep)

    return log.run(docs, write, checkpoint, every)


def merge(spark: SparkSession, out: str, keep: int | None = None) -> None:
    """Bring all segments into the layout of the tables; with `keep`, drop what only versions before the last `keep` read.

    The documents' last version holds the batches the index holds before and after its merge.
    """
    documents, index = _folders(out)
    for root, merged in ((documents, stored_documents.merge_documents), (index, stored_index.merge_index)):
        with passing(spark):
            merged(spark, root)
        if keep:
            v.drop_unused(spark, root, keep)


def _in_step(spark: SparkSession, out: str) -> tuple[v.Version, v.Version]:
    """The last versions of both tables that hold the same batches; documents are written first."""
    documents, index = _folders(out)
    indexed = v.read_version(spark, index)
    for number in reversed(v.versions(spark, documents)):
        version = v.read_version(spark, documents, number)
        if v.batches(version) == v.batches(indexed):
            return version, indexed
    raise ValueError(f"no versions at {out} that hold the same batches")


def current_documents(spark: SparkSession, out: str) -> DataFrame:
    """The last version of each document as of the last batch that is indexed; `created_at` is when its first one came."""
    version, _ = _in_step(spark, out)
    return stored_documents.open_documents(spark, _folders(out)[0], version)


def current_index(spark: SparkSession, out: str) -> Index:
    """The index as of the last batch."""
    return stored_index.open_index(spark, _folders(out)[1], _in_step(spark, out)[1])


def compact(spark: SparkSession, out: str, into: str) -> None:
    """Start new tables from what the old ones hold, without their history."""
    documents, index = _folders(into)
    stored_documents.create_documents(current_documents(spark, out), documents)
    stem = _in_step(spark, out)[1].settings["stem"] == "True"
    stored_index.store_counted(current_index(spark, out).doc_terms, index, stem)
