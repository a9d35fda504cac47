"""Ingest operators and the document table over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiquarry.operators import documents as table
from lexiquarry.operators import ingest
from lexiquarry.operators import stored_documents as stored
from lexiquarry.plans import sql, views
from lexiquarry.session import discard, settle, shared_folder
from lexiquarry.sources import messages, tables

# Limits small enough for the given tables to exceed.
SHORT_CONTENT = 2000
SMALL_BATCH = 300
ARRIVAL = "2024-02-01T00:00:00"


def src01_scan_documents(spark, sf):
    return tables.scan_documents(views.submissions(spark, sf).transform(ingest.assign_shard), 0)


def src02_get_document(spark, sf):
    found = table.get_document(views.documents(spark, sf), "42")
    return found.select("shard_id", "doc_id", "content", "source")


def src03_fetch_documents(spark, sf):
    found = table.fetch_documents(views.documents(spark, sf), views.labels(spark, sf), shard_id=1)
    return found.select("shard_id", "doc_id", "content", "source")


def src08_read_json_documents(spark, sf):
    folder = shared_folder(spark, "json")
    rows = views.submissions(spark, sf).select(
        F.to_json(F.struct(F.col("doc_id").alias("id"), "title", "content", "source", "metadata")).alias("value")
    )
    rows.write.text(folder)
    read = messages.read_json_documents(spark, folder, SHORT_CONTENT)
    return read.select("doc_id", "title", "content", "source", F.col("metadata")["lang"].alias("lang"), "valid", "error")


def src09_explode_bulk(spark, sf):
    one = F.struct(F.col("doc_id").alias("id"), "content", "source")
    two = F.struct(F.col("doc_id").alias("id"), F.col("title").alias("content"), "source")
    bulk = views.pages(spark, sf).select(
        F.col("doc_id").alias("batch_id"),
        F.to_json(F.struct(F.array(one, two).alias("documents"))).alias("payload"),
    )
    rows = messages.explode_bulk(bulk)
    parsed = ingest.validate_json(rows.drop("error"), "document")
    return parsed.select("batch_id", F.col("position").cast("bigint").alias("position"), "doc_id", "content", "error")


def src10_publish_documents(spark, sf):
    folder = shared_folder(spark, "topics")
    messages.publish_documents(views.documents(spark, sf), folder)
    sent = spark.read.schema(messages.MESSAGE).json(f"{folder}/{messages.DOCUMENT_TOPIC}")
    keys = sent.select("key", F.get_json_object("value", "$.id").alias("doc_id"))
    bodies = messages.parse_documents(sent).select("doc_id", "content", "shard_id")
    return bodies.join(keys, "doc_id")


def ing01_validate(spark, sf):
    checked = ingest.validate(views.submissions(spark, sf))
    return checked.select("doc_id", "valid", "error")


def ing01_validate_limit(spark, sf):
    checked = ingest.validate(views.submissions(spark, sf), SHORT_CONTENT)
    return checked.select("doc_id", "valid", "error")


def ing02_split_valid(spark, sf):
    accepted, rejected = ingest.split_valid(ingest.validate(views.submissions(spark, sf), SHORT_CONTENT))
    kept = accepted.select("doc_id", "content", F.lit("").alias("error"))
    return kept.unionByName(rejected.select("doc_id", "content", "error"))


def ing03_check_batch_size(spark, sf):
    docs = views.documents(spark, sf).withColumn("batch_id", F.col("metadata")["lang"])
    return ingest.check_batch_size(docs, max_documents=SMALL_BATCH).select("doc_id", "batch_id", "error")


def ing03_batch_verdicts(spark, sf):
    announced = views.documents(spark, sf).select(F.col("source").alias("batch_id")).distinct()
    extra = views.pages(spark, sf).select(F.col("source").alias("batch_id")).distinct()
    docs = views.reviewed(spark, sf).withColumn("batch_id", F.col("source"))
    return ingest.batch_verdicts(announced.union(extra), docs, max_documents=20)


def ing04_assign_doc_id(spark, sf):
    return ingest.assign_doc_id(views.unnamed(spark, sf)).select("row_id", "doc_id")


def ing05_enrich(spark, sf):
    rich = ingest.enrich(views.texts(spark, sf), ARRIVAL)
    names = ("lang", "ingested_at", "ingestion_service", "content_length", "word_count")
    return rich.select("doc_id", *[F.col("metadata")[n].alias(n) for n in names])


def ing06_assign_shard(spark, sf):
    docs = views.documents(spark, sf).drop("shard_id")
    return ingest.assign_shard(docs).select("doc_id", "shard_id")


def ing07_route_by_shard(spark, sf):
    folder = shared_folder(spark, "documents")
    tables.write_documents(views.documents(spark, sf), folder)
    return tables.read_documents(spark, folder).groupBy("shard_id").agg(F.count("*").alias("documents"))


def ing08_check_shard(spark, sf):
    given = F.coalesce("quality", F.lit(2)).cast("int")
    docs = views.submissions(spark, sf).withColumn("shard_id", given)
    return ingest.check_shard(docs).select("doc_id", "shard_id", "error")


def ing09_upsert_documents(spark, sf):
    after = table.upsert_documents(views.current(spark, sf), views.incoming(spark, sf), views.moment(views.NOW))
    same = F.col("created_at") == F.col("updated_at")
    return after.select("shard_id", "doc_id", "title", "content", "source", "status", same.alias("unmoved"))


def ing09_upsert_results(spark, sf):
    return table.upsert_results(views.current(spark, sf), views.incoming(spark, sf))


def ing09_upsert_stored(spark, sf):
    """The batch on disk: rows as they lie there, and what became of each."""
    root = shared_folder(spark, "stored")
    stored.create_documents(views.current(spark, sf), root)
    done = stored.upsert_documents(spark, root, views.incoming(spark, sf), views.moment(views.NOW))
    done = done.select("shard_id", "doc_id", F.col("status").alias("done"))
    same = F.col("created_at") == F.col("updated_at")
    return stored.open_documents(spark, root).join(done, ["shard_id", "doc_id"], "left").select(
        "shard_id", "doc_id", "title", "content", "source",
        F.coalesce("done", F.lit("unchanged")).alias("status"), same.alias("unmoved"),
    )


def ing10_delete_stored(spark, sf):
    root = shared_folder(spark, "stored")
    stored.create_documents(views.documents(spark, sf), root)
    stored.delete_documents(spark, root, _doomed(spark, sf))
    stored.merge_documents(spark, root)
    return stored.open_documents(spark, root).select("shard_id", "doc_id", "content")


def src08_nested_metadata(spark, sf):
    """Arrays, objects and numbers of the metadata from JSON through messages and an upsert into the stored table."""
    rows = views.table(spark, sf, "documents")
    metadata = F.struct(
        F.array("lang", "source").alias("tags"), F.col("n_chars").alias("n"), F.struct("lang").alias("deep"),
        F.lit(0).alias("word_count"),
    )
    payload = F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("content"), metadata.alias("metadata")))
    read = ingest.validate_json(rows.select(payload.alias("payload")), nested=True)
    ready = ingest.assign_shard(ingest.enrich(read.where("valid"), ARRIVAL))
    sent = messages.parse_documents(messages.document_messages(ready), nested=True)
    root = shared_folder(spark, "stored")
    moments = {c: views.moment(views.NOW) for c in ("created_at", "updated_at")}
    # Both writes read it, and a filter on an id would be pushed below the parsing and parse all texts again.
    sent = settle(sent.withColumns({**moments, "seq": F.lit(0)}), "sent")
    stored.create_documents(sent.where("doc_id % 2 = 0"), root)
    stored.upsert_documents(spark, root, sent, views.moment(views.NOW))
    discard(sent)
    stored.merge_documents(spark, root)
    get = lambda path, kind: F.try_variant_get("metadata", path, kind)
    return stored.open_documents(spark, root).select(
        "shard_id", "doc_id",
        get("$.tags[1]", "string").alias("tag"), get("$.n", "bigint").alias("n"),
        get("$.deep.lang", "string").alias("lang"), get("$.word_count", "bigint").alias("word_count"),
        F.schema_of_variant(get("$.n", "variant")).alias("kind"),
    )


def _doomed(spark, sf):
    """Toxic documents, and ids nobody stored."""
    absent = views.pages(spark, sf).select("shard_id", "doc_id")
    return views.toxic(spark, sf).unionByName(absent)


def ing10_delete_documents(spark, sf):
    return table.delete_documents(views.documents(spark, sf), _doomed(spark, sf)).select("shard_id", "doc_id", "content")


def ing10_delete_results(spark, sf):
    return table.delete_results(views.documents(spark, sf), _doomed(spark, sf))


def ing11_ingest_stats(spark, sf):
    return ingest.ingest_stats(ingest.validate(views.submissions(spark, sf), SHORT_CONTENT))


def ing12_bulk_summary(spark, sf):
    checked = ingest.validate(ingest.assign_shard(views.submissions(spark, sf)))
    return ingest.bulk_summary(checked)


def ing12_document_results(spark, sf):
    results = ingest.document_results(views.pages(spark, sf))
    return results.select("shard_id", "doc_id", "tokens_processed", "typeahead_terms")


def ing13_dry_run(spark, sf):
    rows = views.submissions(spark, sf).withColumn("doc_id", F.lit(None).cast("string"))
    tried = ingest.dry_run(rows, ARRIVAL)
    return tried.select(
        "valid", "error", "doc_id", "shard_id", F.col("metadata")["word_count"].alias("word_count")
    )


def idx10_document_counts(spark, sf):
    counts = table.document_counts(views.documents(spark, sf))
    return counts.select("shard_id", "document_count", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss").alias("last_updated"))


def idx11_seed_shards(spark, sf):
    """Five shards wanted, three in use."""
    return table.shard_metadata(views.documents(spark, sf), 5).select("shard_id", "document_count", "status")


QUERIES = {
    f.__name__: f
    for f in (
        src01_scan_documents,
        src02_get_document,
        src03_fetch_documents,
        src08_read_json_documents,
        src09_explode_bulk,
        src10_publish_documents,
        ing01_validate,
        ing01_validate_limit,
        ing02_split_valid,
        ing03_check_batch_size,
        ing03_batch_verdicts,
        ing04_assign_doc_id,
        ing05_enrich,
        ing06_assign_shard,
        ing07_route_by_shard,
        ing08_check_shard,
        ing09_upsert_documents,
        ing09_upsert_results,
        ing10_delete_documents,
        ing10_delete_results,
        src08_nested_metadata,
        ing09_upsert_stored,
        ing10_delete_stored,
        ing11_ingest_stats,
        ing12_bulk_summary,
        ing12_document_results,
        ing13_dry_run,
        idx10_document_counts,
        idx11_seed_shards,
    )
}


def _error(limit: int) -> str:
    return (
        "CASE WHEN content IS NULL THEN 'Missing required field: content' "
        "WHEN content = '' THEN 'Content must be a non-empty string' "
        f"WHEN length(content) > {limit} THEN 'Content exceeds maximum size limit (10MB)' ELSE '' END"
    )


def _checked(limit: int) -> str:
    return f"checked AS (SELECT *, {_error(limit)} = '' AS valid, {_error(limit)} AS error FROM submissions)"


_SUBMITTED = (sql.DOCS, sql.MARKS, sql.SUBMISSIONS)
_FULL = ingest.MAX_CONTENT_CHARS
WORDS_SQL = f"len(list_filter(string_split_regex(content, concat('[', {sql.WHITE_SQL}, ']+')), lambda w: w <> ''))"
_CURRENT = (
    "present AS (SELECT shard_id, doc_id, title, content, source FROM docs UNION ALL "
    "SELECT shard_id, doc_id, title, content, source FROM turns WHERE seq = 0)"
)
_INCOMING = (
    "incoming AS (SELECT shard_id, doc_id, title, content, source, seq FROM turns UNION ALL "
    "SELECT shard_id, doc_id, title, content, source, 0 FROM reviewed UNION ALL "
    "SELECT shard_id, doc_id, title, content, source, 0 FROM page_docs)"
)
_UPSERT = (sql.DOCS, sql.MARKS, sql.TURNS, sql.PAGE_DOCS, sql.REVIEWED, _CURRENT, _INCOMING)
_DOOMED = (
    "doomed AS (SELECT shard_id, doc_id FROM docs WHERE doc_id IN (SELECT doc_id FROM marks WHERE toxic = 1) "
    "UNION ALL SELECT shard_id, doc_id FROM page_docs)"
)

ORACLES = {
    "src01_scan_documents": sql.with_(*_SUBMITTED)
    + "SELECT doc_id, title, coalesce(content, '') AS content FROM submissions WHERE shard_id = 0",
    "src02_get_document": sql.with_(sql.DOCS)
    + "SELECT shard_id, doc_id, content, source FROM docs WHERE doc_id = '42'",
    "src03_fetch_documents": sql.with_(sql.DOCS, sql.MARKS)
    + "SELECT shard_id, doc_id, content, source FROM docs WHERE shard_id = 1 AND doc_id IN (SELECT doc_id FROM marks)",
    "src08_read_json_documents": sql.with_(*_SUBMITTED, _checked(SHORT_CONTENT))
    + "SELECT doc_id, title, content, source, lang, valid, error FROM checked",
    "src09_explode_bulk": sql.with_(sql.PAGE_DOCS)
    + "SELECT doc_id AS batch_id, CAST(0 AS BIGINT) AS position, doc_id, content, '' AS error FROM page_docs "
    "UNION ALL SELECT doc_id, 1, doc_id, title, '' FROM page_docs",
    "src10_publish_documents": sql.with_(sql.DOCS)
    + "SELECT doc_id, content, shard_id, 'shard-' || CAST(shard_id AS VARCHAR) AS key FROM docs",
    "ing01_validate": sql.with_(*_SUBMITTED, _checked(_FULL)) + "SELECT doc_id, valid, error FROM checked",
    "ing01_validate_limit": sql.with_(*_SUBMITTED, _checked(SHORT_CONTENT))
    + "SELECT doc_id, valid, error FROM checked",
    "ing02_split_valid": sql.with_(*_SUBMITTED, _checked(SHORT_CONTENT))
    + "SELECT doc_id, content, error FROM checked",
    "ing03_check_batch_size": sql.with_(sql.DOCS)
    + "SELECT doc_id, lang AS batch_id, CASE WHEN count(*) OVER (PARTITION BY lang) > "
    f"{SMALL_BATCH} THEN '{ingest.BATCH_TOO_LARGE}' ELSE '' END AS error FROM docs",
    "ing03_batch_verdicts": sql.with_(
        sql.DOCS,
        sql.MARKS,
        sql.REVIEWED,
        "announced AS (SELECT DISTINCT source AS batch_id FROM docs UNION ALL SELECT DISTINCT url FROM pages)",
        "sizes AS (SELECT source AS batch_id, count(*) AS n FROM reviewed GROUP BY ALL)",
    )
    + "SELECT batch_id, coalesce(n, 0) AS documents, CASE WHEN n IS NULL THEN 'No documents provided' "
    f"WHEN n > 20 THEN '{ingest.BATCH_TOO_LARGE}' ELSE '' END AS error FROM announced LEFT JOIN sizes USING (batch_id)",
    "ing04_assign_doc_id": sql.with_(*_SUBMITTED[:2])
    + "SELECT d.doc_id AS row_id, CASE WHEN toxic = 0 THEN d.doc_id ELSE md5(content) END AS doc_id "
    "FROM docs d LEFT JOIN marks USING (doc_id)",
    "ing05_enrich": sql.with_(sql.DOCS)
    + f"SELECT doc_id, lang, '{ARRIVAL}' AS ingested_at, 'data-ingestion' AS ingestion_service, "
    f"CAST(length(content) AS VARCHAR) AS content_length, CAST({WORDS_SQL} AS VARCHAR) AS word_count FROM docs",
    "ing06_assign_shard": sql.with_(sql.DOCS) + "SELECT doc_id, shard_id FROM docs",
    "ing07_route_by_shard": sql.with_(sql.DOCS)
    + "SELECT shard_id, count(*) AS documents FROM docs GROUP BY ALL",
    "ing08_check_shard": sql.with_(
        *_SUBMITTED, "given AS (SELECT doc_id, shard_id AS expected, coalesce(quality, 2) AS shard_id FROM submissions)"
    )
    + "SELECT doc_id, CAST(shard_id AS INTEGER) AS shard_id, CASE WHEN shard_id <> expected THEN "
    "'Document assigned to wrong shard. Expected ' || expected || ', got ' || shard_id ELSE '' END AS error FROM given",
    "ing09_upsert_documents": sql.with_(
        *_UPSERT,
        "newest AS (SELECT * FROM incoming QUALIFY row_number() OVER (PARTITION BY shard_id, doc_id ORDER BY seq DESC) = 1)",
    )
    + "SELECT p.shard_id, p.doc_id, title, content, source, 'unchanged' AS status, true AS unmoved "
    "FROM present p ANTI JOIN newest USING (shard_id, doc_id) UNION ALL "
    "SELECT n.shard_id, n.doc_id, n.title, n.content, n.source, "
    "CASE WHEN p.doc_id IS NULL THEN 'indexed' ELSE 'updated' END, p.doc_id IS NULL "
    "FROM newest n LEFT JOIN present p USING (shard_id, doc_id)",
    "ing09_upsert_results": sql.with_(*_UPSERT)
    + "SELECT i.shard_id, i.doc_id, seq, CASE WHEN p.doc_id IS NULL AND row_number() OVER "
    "(PARTITION BY i.shard_id, i.doc_id ORDER BY seq) = 1 THEN 'indexed' ELSE 'updated' END AS status "
    "FROM incoming i LEFT JOIN present p USING (shard_id, doc_id)",
    "ing10_delete_documents": sql.with_(sql.DOCS, sql.MARKS, sql.KEPT)
    + "SELECT shard_id, doc_id, content FROM kept",
    "ing10_delete_results": sql.with_(sql.DOCS, sql.MARKS, sql.PAGE_DOCS, _DOOMED)
    + "SELECT x.shard_id, x.doc_id, CASE WHEN d.doc_id IS NULL THEN '' ELSE 'deleted' END AS status, "
    "CASE WHEN d.doc_id IS NULL THEN 'Document not found' ELSE '' END AS error "
    "FROM doomed x LEFT JOIN docs d USING (shard_id, doc_id)",
    "ing11_ingest_stats": sql.with_(*_SUBMITTED, _checked(SHORT_CONTENT))
    + "SELECT count(*) AS documents_received, count(*) FILTER (valid) AS documents_processed, "
    "count(*) FILTER (NOT valid) AS documents_failed, "
    "CAST(coalesce(sum(strlen(content)) FILTER (valid), 0) AS BIGINT) AS bytes_processed FROM checked",
    "ing12_bulk_summary": sql.with_(*_SUBMITTED, _checked(_FULL))
    + "SELECT shard_id, count(*) AS total, count(*) FILTER (valid) AS successful, "
    "count(*) FILTER (NOT valid) AS failed FROM checked GROUP BY ALL",
    "ing12_document_results": sql.with_(sql.PAGE_DOCS, sql.words("page_docs"))
    + "SELECT p.shard_id, p.doc_id, count(term) AS tokens_processed, "
    "count(term) FILTER (length(term) >= 2) AS typeahead_terms "
    "FROM page_docs p LEFT JOIN words USING (shard_id, doc_id) GROUP BY ALL",
    "ing13_dry_run": sql.with_(*_SUBMITTED, _checked(_FULL))
    + "SELECT valid, error, CASE WHEN valid THEN md5(content) END AS doc_id, "
    f"CASE WHEN valid THEN {sql.shard('md5(content)', 3)} END AS shard_id, "
    f"CASE WHEN valid THEN CAST({WORDS_SQL} AS VARCHAR) END AS word_count FROM checked",
    "idx10_document_counts": sql.with_(sql.DOCS)
    + "SELECT shard_id, count(*) AS document_count, "
    "strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS last_updated FROM docs GROUP BY ALL",
    "idx11_seed_shards": sql.with_(sql.DOCS)
    + "SELECT CAST(s.i AS INTEGER) AS shard_id, count(d.doc_id) AS document_count, 'active' AS status "
    "FROM range(5) s(i) LEFT JOIN docs d ON d.shard_id = s.i GROUP BY ALL",
}
ORACLES["ing09_upsert_stored"] = ORACLES["ing09_upsert_documents"]
ORACLES["ing10_delete_stored"] = ORACLES["ing10_delete_documents"]
ORACLES["src08_nested_metadata"] = (
    f"SELECT {sql.shard('CAST(doc_id AS VARCHAR)', 3)} AS shard_id, CAST(doc_id AS VARCHAR) AS doc_id, source AS tag, "
    f"n_chars AS n, lang, CAST({WORDS_SQL.replace('content', 'text')} AS BIGINT) AS word_count, 'BIGINT' AS kind "
    "FROM documents WHERE text <> ''"
)
