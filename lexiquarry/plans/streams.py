"""Streaming operators run to the end of the given tables; results equal the batch operators'."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiquarry.operators.terms import KEY
from lexiquarry.plans import ingest, sql, terms, views
from lexiquarry.session import freed_shuffles, shared_folder
from lexiquarry.sources import messages
from lexiquarry.streaming import index as index_streams
from lexiquarry.streaming import ingest as ingest_streams
from lexiquarry.streaming import log
from lexiquarry.streaming import terms as term_streams

# How long a run over the given tables may take.
SECONDS = 1800


def _stream_of(spark, name, *parts):
    """The frames written to a folder one after the other and read back as a stream.

    Files arrive in the order they were written, a few per micro-batch, and are
    deleted once the next one starts, for nothing else reads them.
    """
    folder = shared_folder(spark, name)
    with freed_shuffles(spark):
        for rows in parts:
            rows.write.mode("append").parquet(folder)
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", "16")
    return stream.option("cleanSource", "delete").parquet(folder)


def _finish(query):
    try:
        if not query.awaitTermination(SECONDS):
            raise TimeoutError(f"stream still running after {SECONDS} seconds")
    finally:
        query.stop()


def src12_read_document_stream(spark, sf):
    folder, out = shared_folder(spark, "topics"), shared_folder(spark, "received")
    messages.publish_documents(views.documents(spark, sf), folder)
    stream = messages.read_document_stream(spark, folder)
    _finish(log.run(stream, lambda rows, n: log.append(rows, out, n), shared_folder(spark, "offsets")))
    return log.read_log(spark, out).select("shard_id", "doc_id", "content", "source")


def src12_read_term_update_stream(spark, sf):
    folder, out = shared_folder(spark, "topics"), shared_folder(spark, "received")
    messages.publish_term_updates(views.stored_terms(spark, sf), folder)
    stream = messages.read_term_update_stream(spark, folder)
    _finish(log.run(stream, lambda rows, n: log.append(rows, out, n), shared_folder(spark, "offsets")))
    return log.read_log(spark, out).select(*KEY, "frequency_delta")


def str01_ingest_stream(spark, sf):
    out = shared_folder(spark, "ingested")
    raw = _stream_of(spark, "raw", views.submissions(spark, sf))
    arrival = F.lit(ingest.ARRIVAL)
    _finish(ingest_streams.start_ingest(raw, arrival, out, shared_folder(spark, "offsets"), folder=out))
    sent = spark.read.schema(messages.MESSAGE).option("recursiveFileLookup", "true")
    accepted = messages.parse_documents(sent.json(f"{out}/{messages.DOCUMENT_TOPIC}"))
    rejected = log.read_log(spark, f"{out}/rejected")
    return accepted.select("doc_id", "shard_id", "content", F.lit("").alias("error")).unionByName(
        rejected.select("doc_id", "shard_id", "content", "error")
    )


def _indexed(spark, sf):
    """Documents arrive first, then their reviews, pages and conversations.

    Versions of one document are written to one file, so that none overtakes another.
    """
    out = shared_folder(spark, "indexed")
    columns = ["shard_id", "doc_id", "title", "content", "source", "metadata"]
    first = views.texts(spark, sf).select(*columns, F.lit(-1).cast("bigint").alias("seq"))
    later = views.incoming(spark, sf).select(*first.columns).repartition("doc_id")
    stream = _stream_of(spark, "arriving", first, later)
    now = views.moment(views.NOW)
    _finish(
        index_streams.index_stream(stream, out, shared_folder(spark, "offsets"), now, stem=False, keep=1)
    )
    return out


def str02_index_stream_documents(spark, sf):
    docs = index_streams.current_documents(spark, _indexed(spark, sf))
    return docs.select("shard_id", "doc_id", "title", "content", "source")


def str02_index_stream_postings(spark, sf):
    index = index_streams.current_index(spark, _indexed(spark, sf))
    return index.postings.select("shard_id", "term", "doc_id", "tf")


def _ingested(spark, sf):
    """Raw documents through the topic into the table and index."""
    topics, out = shared_folder(spark, "topics"), shared_folder(spark, "indexed")
    raw = _stream_of(spark, "raw", views.submissions(spark, sf))
    arrival, now = F.lit(ingest.ARRIVAL), views.moment(views.NOW)
    _finish(ingest_streams.start_ingest(raw, arrival, out, shared_folder(spark, "offsets"), folder=topics))
    docs = messages.read_document_stream(spark, topics)
    _finish(index_streams.index_stream(docs, out, shared_folder(spark, "offsets"), now, stem=False, keep=1))
    return out


def str02_ingest_to_index(spark, sf):
    index = index_streams.current_index(spark, _ingested(spark, sf))
    return index.postings.select("shard_id", "term", "doc_id", "tf")


def str02_ingest_to_documents(spark, sf):
    docs = index_streams.current_documents(spark, _ingested(spark, sf))
    return docs.select(
        "shard_id", "doc_id", "title", "content", "source", "status",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.element_at("metadata", "ingested_at").alias("ingested_at"),
        F.element_at("metadata", "word_count").alias("word_count"),
    )


def str03_term_count_stream(spark, sf):
    out = shared_folder(spark, "counts")
    counts = term_streams.term_count_stream(_stream_of(spark, "documents", views.texts(spark, sf)))
    _finish(term_streams.start_counts(counts, out, shared_folder(spark, "offsets")))
    return term_streams.current_frequencies(spark, out)


def str04_sync_stream(spark, sf):
    out = shared_folder(spark, "synced")
    term_streams.seed_frequencies(views.stored_terms(spark, sf), out)
    stream = _stream_of(spark, "counters", views.counters(spark, sf))
    _finish(term_streams.sync_stream(stream, out, shared_folder(spark, "offsets"), every=None))
    return term_streams.current_frequencies(spark, out)


def str05_update_stream(spark, sf):
    out = shared_folder(spark, "updated")
    term_streams.seed_frequencies(views.event_terms(spark, sf), out)
    pending = views.updates(spark, sf).where("not processed").repartition(*KEY)
    stream = _stream_of(spark, "updates", pending.select(*KEY, "frequency_delta"))
    _finish(term_streams.update_stream(stream, out, shared_folder(spark, "offsets")))
    return term_streams.current_frequencies(spark, out)


QUERIES = {
    f.__name__: f
    for f in (
        src12_read_document_stream,
        src12_read_term_update_stream,
        str01_ingest_stream,
        str02_index_stream_documents,
        str02_index_stream_postings,
        str02_ingest_to_index,
        str02_ingest_to_documents,
        str03_term_count_stream,
        str04_sync_stream,
        str05_update_stream,
    )
}

_UPSERTED = (
    sql.DOCS,
    sql.MARKS,
    sql.TURNS,
    sql.PAGE_DOCS,
    sql.REVIEWED,
    "arrived AS (SELECT shard_id, doc_id, title, content, source, -1 AS seq FROM docs UNION ALL "
    "SELECT shard_id, doc_id, title, content, source, seq FROM turns UNION ALL "
    "SELECT shard_id, doc_id, title, content, source, 0 FROM reviewed UNION ALL "
    "SELECT shard_id, doc_id, title, content, source, 0 FROM page_docs)",
    "newest AS (SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY shard_id, doc_id ORDER BY seq DESC) = 1)",
)

_ACCEPTED = (sql.DOCS, sql.MARKS, sql.SUBMISSIONS, "accepted AS (SELECT * FROM submissions WHERE content <> '')")

ORACLES = {
    "src12_read_document_stream": sql.with_(sql.DOCS)
    + "SELECT shard_id, doc_id, content, source FROM docs",
    "src12_read_term_update_stream": terms.ORACLES["src11_publish_term_updates"],
    "str01_ingest_stream": sql.with_(sql.DOCS, sql.MARKS, sql.SUBMISSIONS)
    + "SELECT doc_id, CASE WHEN content <> '' THEN shard_id END AS shard_id, content, "
    "CASE WHEN content IS NULL THEN 'Missing required field: content' "
    "WHEN content = '' THEN 'Content must be a non-empty string' ELSE '' END AS error FROM submissions",
    "str02_index_stream_documents": sql.with_(*_UPSERTED)
    + "SELECT shard_id, doc_id, title, content, source FROM newest",
    "str02_index_stream_postings": sql.with_(*_UPSERTED, sql.words("newest"))
    + "SELECT shard_id, term, doc_id, count(*) AS tf FROM words GROUP BY ALL",
    "str02_ingest_to_index": sql.with_(*_ACCEPTED, sql.words("accepted"))
    + "SELECT shard_id, term, doc_id, count(*) AS tf FROM words GROUP BY ALL",
    "str02_ingest_to_documents": sql.with_(*_ACCEPTED)
    + f"SELECT shard_id, doc_id, title, content, source, 'indexed' AS status, '{views.NOW}' AS created_at, "
    f"'{ingest.ARRIVAL}' AS ingested_at, CAST({ingest.WORDS_SQL} AS VARCHAR) AS word_count FROM accepted",
    "str03_term_count_stream": terms.ORACLES["trm01_term_counts"],
    "str04_sync_stream": terms.ORACLES["trm13_sync_terms"],
    "str05_update_stream": terms.ORACLES["trm16_apply_batch"],
}
