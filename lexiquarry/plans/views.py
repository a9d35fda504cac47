"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions.hashing import DOCUMENT_SHARDS, shard_of
from lexiquarry.operators import terms as term_ops
from lexiquarry.operators.documents import FIELDS
from lexiquarry.operators.index import Index, read_index, store_index
from lexiquarry.session import shared_folder, spread

# Until when the events count as processed.
PROCESSED_UNTIL = "2024-01-20 00:00:00"
# The instant time-dependent operators are asked at.
NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz").cast("timestamp")


def _after(seconds):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return (start + F.make_dt_interval(secs=seconds)).cast("timestamp")


def _as_documents(rows: DataFrame, doc_id, title, content, source, metadata, seconds) -> DataFrame:
    return rows.select(
        doc_id.alias("doc_id"),
        title.alias("title"),
        content.alias("content"),
        source.alias("source"),
        metadata.alias("metadata"),
        shard_of(doc_id, DOCUMENT_SHARDS).alias("shard_id"),
        _after(seconds).alias("created_at"),
        _after(seconds).alias("updated_at"),
    )


def documents(spark: SparkSession, sf: str, scan: DataFrame | None = None) -> DataFrame:
    """The corpus: one untitled document per row of `documents`."""
    return _as_documents(
        table(spark, sf, "documents") if scan is None else scan,
        F.col("doc_id").cast("string"),
        F.lit(""),
        F.col("text"),
        F.col("source"),
        F.create_map(F.lit("lang"), F.col("lang")),
        F.col("doc_id"),
    )


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus for work on whole texts: a small table is spread over all cores."""
    return documents(spark, sf, spread(table(spark, sf, "documents"), "doc_id"))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """Titled documents: the web pages without their tags."""
    return _as_documents(
        table(spark, sf, "pages"),
        F.concat(F.lit("page-"), F.col("page_id").cast("string")),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1),
        F.regexp_replace("html", "<[^>]*>", " "),
        F.col("url"),
        F.create_map(F.lit("kind"), F.lit("page")),
        F.col("page_id"),
    )


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn of a conversation as a version of the conversation's document."""
    rows = table(spark, sf, "conversations")
    docs = _as_documents(
        rows.select("*", F.col("turn").alias("_seq")),
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")),
        F.col("role"),
        F.col("text"),
        F.lit("conversations"),
        F.create_map(F.lit("turn"), F.col("turn").cast("string")),
        F.col("conv_id"),
    )
    return docs.withColumn("seq", F.col("metadata")["turn"].cast("bigint"))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Second corpus: every turn is a document of its own."""
    return _as_documents(
        table(spark, sf, "conversations"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")),
        F.lit(""),
        F.col("text"),
        F.col("role"),
        F.create_map(F.lit("role"), F.col("role")),
        F.col("conv_id"),
    )


def queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels")
    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), "quality", "toxic")


def reviewed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a review, retitled by it."""
    marked = documents(spark, sf).join(labels(spark, sf), "doc_id")
    title = F.concat(F.lit("quality "), F.col("quality").cast("string"))
    return marked.withColumn("title", title).drop("quality", "toxic")


def toxic(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of documents reviewed as toxic."""
    ids = labels(spark, sf).where("toxic = 1")
    return ids.select(shard_of("doc_id", DOCUMENT_SHARDS).alias("shard_id"), "doc_id")


def kept(spark: SparkSession, sf: str) -> DataFrame:
    """The document table after the toxic documents went."""
    return documents(spark, sf).join(toxic(spark, sf), ["shard_id", "doc_id"], "left_anti")


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    """Raw input with faults: text only arrives with a review and is blanked when toxic."""
    docs = documents(spark, sf).join(labels(spark, sf), "doc_id", "left")
    content = F.when(F.col("toxic") == 1, "").when(F.col("toxic") == 0, F.col("content"))
    return docs.select(
        "doc_id", "title", content.alias("content"), "source", "metadata", "quality", "toxic"
    )


def unnamed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that have an id only with a review, and an empty one when toxic."""
    docs = documents(spark, sf).join(labels(spark, sf), "doc_id", "left")
    doc_id = F.when(F.col("toxic") == 1, "").when(F.col("toxic") == 0, F.col("doc_id"))
    return docs.select(doc_id.alias("doc_id"), F.col("doc_id").alias("row_id"), "content")


def current(spark: SparkSession, sf: str) -> DataFrame:
    """Stored documents before the upsert: the corpus and first turns of conversations."""
    first = turns(spark, sf).where("seq = 0").drop("seq")
    return documents(spark, sf).unionByName(first)


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with updates, repeated documents and new ones."""
    columns = ["shard_id", "doc_id", *FIELDS]
    once = reviewed(spark, sf).unionByName(pages(spark, sf)).withColumn("seq", F.lit(0).cast("bigint"))
    return turns(spark, sf).unionByName(once).select(*columns, "seq")


def updates(spark: SparkSession, sf: str) -> DataFrame:
    """Signed term updates: one per event."""
    rows = table(spark, sf, "events")
    number = F.regexp_extract("props", "[0-9]+", 0)
    changes = rows.select(
        F.concat_ws("-", F.col("event_type"), number).alias("term"),
        F.when(F.col("value") >= 40, 1).otherwise(-1).cast("bigint").alias("frequency_delta"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("batch_id"),
        F.col("ts").cast("timestamp").alias("created_at"),
        (F.col("ts").cast("timestamp") < moment(PROCESSED_UNTIL)).alias("processed"),
    )
    return term_ops.assign_term_shard(changes)


def event_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Stored terms of the update buffer: what the processed events other than purchases named."""
    done = updates(spark, sf).where("processed and not startswith(term, 'purchase')")
    return done.groupBy("shard_id", "term").agg(F.count("*").alias("frequency"))


def stored_terms(spark: SparkSession, sf: str) -> DataFrame:
    return term_ops.term_counts(texts(spark, sf))


def benchmark_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Terms of the benchmark texts."""
    rows = table(spark, sf, "benchmark").select(F.lit("").alias("title"), F.col("text").alias("content"), F.col("item_id").cast("string").alias("doc_id"))
    return term_ops.term_counts(rows).select("shard_id", "term")


def counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of the second corpus; terms of the benchmark texts are tombstones."""
    counts = term_ops.term_counts(messages(spark, sf))
    return term_ops.remove_terms(counts, benchmark_terms(spark, sf))


def prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """Asked prefixes: every word of the benchmark texts, spelled as typed."""
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return words.select(F.concat(F.lit(" "), F.col("word")).alias("prefix"))


_stored: dict[tuple[str, str, bool], str] = {}


def stored_index(spark: SparkSession, sf: str, stem: bool) -> Index:
    """The corpus index as stored tables, built once per application."""
    key = (spark.sparkContext.applicationId, sf, stem)
    if key not in _stored:
        path = shared_folder(spark, "index")
        store_index(texts(spark, sf), path, stem)
        _stored[key] = path
    return read_index(spark, _stored[key])
