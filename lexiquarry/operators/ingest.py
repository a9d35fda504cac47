"""Validation, enrichment and routing of incoming documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiquarry.functions.hashing import DOCUMENT_SHARDS, content_id, shard_of
from lexiquarry.functions.text import full_text, preprocess, word_count
from lexiquarry.session import lookup_side

# Limits and the messages of rejected documents.
MAX_CONTENT_CHARS = 10 * 1024 * 1024
MAX_BATCH_DOCUMENTS = 1000
SERVICE_NAME = "data-ingestion"
NO_DATA = "No JSON data provided"
MALFORMED = "Malformed JSON"
CONTENT_MISSING = "Missing required field: content"
CONTENT_EMPTY = "Content must be a non-empty string"
CONTENT_TOO_LONG = "Content exceeds maximum size limit (10MB)"
TITLE_TYPE = "Title must be a string"
SOURCE_TYPE = "Source must be a string"
METADATA_TYPE = "Metadata must be a dictionary"
BATCH_EMPTY = "No documents provided"
BATCH_TOO_LARGE = "Batch size exceeds maximum limit (1000 documents)"


def _verdict(df: DataFrame, error: Column) -> DataFrame:
    return df.withColumn("error", error).withColumn("valid", F.col("error") == "")


def validate(df: DataFrame, max_chars: int = MAX_CONTENT_CHARS) -> DataFrame:
    """Add `valid` and `error` ("" when valid) to typed rows; the first failing rule counts.

    A column cannot hold a value of the wrong type, so only the content rules
    apply. NULL means absent.
    """
    return _verdict(
        df,
        F.when(F.col("content").isNull(), CONTENT_MISSING)
        .when(F.col("content") == "", CONTENT_EMPTY)
        .when(F.length("content") > max_chars, CONTENT_TOO_LONG)
        .otherwise(""),
    )


def _kind(part: Column) -> Column:
    """STRING, OBJECT, ARRAY, VOID (an explicit null) or another type; NULL when absent."""
    return F.split_part(F.split_part(F.schema_of_variant(part), F.lit("<"), F.lit(1)), F.lit("("), F.lit(1))


def _text(part: Column) -> Column:
    """A string as it is, null as NULL, anything else as JSON text."""
    kind = _kind(part)
    return F.when(kind == "STRING", F.try_variant_get(part, "$", "string")).when(kind != "VOID", F.to_json(part))


def validate_json(
    df: DataFrame, payload: str = "payload", max_chars: int = MAX_CONTENT_CHARS, nested: bool = False
) -> DataFrame:
    """Parse JSON documents and validate them with the type rules.

    An explicit JSON null counts as present: a null title fails its type rule.
    Of a repeated key the last counts. Payloads that hold nothing (null, false,
    0, an empty text, array or object) are no data. Metadata is a map of
    strings, in which nested values are JSON text; with `nested` it is a VARIANT
    that keeps them, and their types.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # A row of its own for the parsed text: no filter on what is in it is pushed below the parsing, which would parse once a rule.
    parsed = df.select("*", F.explode_outer(F.array(F.try_parse_json(payload))).alias("_doc"))
    part = {n: F.try_variant_get("_doc", f"$.{n}", "variant") for n in ("id", "content", "title", "source", "metadata")}
    parsed = parsed.withColumns({f"_{n}": _kind(part[n]) for n in ("content", "title", "source", "metadata")})
    if nested:
        metadata = part["metadata"]
    else:
        metadata = F.transform_values(part["metadata"].cast("map<string,variant>"), lambda _, x: _text(x))
    nothing = F.to_json("_doc").isin("null", "false", '""', "[]", "{}") | (
        _kind(F.col("_doc")).isin("BIGINT", "DECIMAL", "DOUBLE") & (F.try_variant_get("_doc", "$", "double") == 0)
    )
    # An object with fields holds something; its whole text is not written to see that.
    fields = F.schema_of_variant("_doc")
    nothing = F.when(fields.startswith("OBJECT<") & (fields != "OBJECT<>"), False).otherwise(nothing)
    parsed = parsed.select(
        *df.columns,
        _text(part["id"]).alias("doc_id"),
        *[F.when(F.col(f"_{n}") == "STRING", _text(part[n])).alias(n) for n in ("title", "content", "source")],
        F.when(F.col("_metadata") == "OBJECT", metadata).alias("metadata"),
        *["_content", "_title", "_source", "_metadata"],
        F.col("_doc").isNull().alias("_malformed"),
        nothing.alias("_nothing"),
    )
    error = (
        F.when(F.col("_malformed"), MALFORMED)
        .when(F.col("_nothing"), NO_DATA)
        .when(F.col("_content").isNull(), CONTENT_MISSING)
        .when((F.col("_content") != "STRING") | (F.col("content") == ""), CONTENT_EMPTY)
        .when(F.length("content") > max_chars, CONTENT_TOO_LONG)
        .when(F.col("_title") != "STRING", TITLE_TYPE)
        .when(F.col("_source") != "STRING", SOURCE_TYPE)
        .when(F.col("_metadata") != "OBJECT", METADATA_TYPE)
        .otherwise("")
    )
    return _verdict(parsed, error).drop("_content", "_title", "_source", "_metadata", "_malformed", "_nothing")


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the verdict columns, and rejected rows with their reason."""
    return validated.where("valid").drop("valid", "error"), validated.where(~F.col("valid"))


def batch_verdicts(
    batches: DataFrame,
    documents: DataFrame,
    batch: str = "batch_id",
    max_documents: int = MAX_BATCH_DOCUMENTS,
) -> DataFrame:
    """One row per announced batch with its document count and an error ("" when fine)."""
    sizes = documents.groupBy(batch).agg(F.count("*").alias("documents"))
    n = F.coalesce("documents", F.lit(0).cast("bigint"))
    return batches.join(sizes, batch, "left").select(
        batch,
        n.alias("documents"),
        F.when(n == 0, BATCH_EMPTY).when(n > max_documents, BATCH_TOO_LARGE).otherwise("").alias("error"),
    )


def check_batch_size(
    documents: DataFrame, batch: str = "batch_id", max_documents: int = MAX_BATCH_DOCUMENTS
) -> DataFrame:
    """Documents with `error`; every document of an oversized batch is rejected."""
    oversized = (
        documents.groupBy(batch)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > max_documents)
        .select(batch, F.lit(BATCH_TOO_LARGE).alias("error"))
    )
    return documents.join(lookup_side(oversized), batch, "left").withColumn(
        "error", F.coalesce("error", F.lit(""))
    )


def assign_doc_id(df: DataFrame) -> DataFrame:
    """Absent and empty ids become the md5 of the content."""
    return df.withColumn("doc_id", content_id("doc_id", "content"))


def enrich(df: DataFrame, ingested_at) -> DataFrame:
    """Add arrival time, service name, content length and word count to the metadata.

    `ingested_at` (a value or column) is passed in, so a replayed batch gives the
    same rows. Added entries win over given ones of the same name. In VARIANT
    metadata the counts are numbers, and nested values stay.
    """
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    added = {
        "ingested_at": at.cast("string"),
        "ingestion_service": F.lit(SERVICE_NAME),
        "content_length": F.length("content"),
        "word_count": word_count("content"),
    }
    nested = isinstance(df.schema["metadata"].dataType, T.VariantType)
    value = "variant" if nested else "string"
    given = F.col("metadata").cast("map<string,variant>") if nested else F.col("metadata")
    given = F.coalesce(given, F.create_map().cast(f"map<string,{value}>"))
    given = F.map_filter(given, lambda key, _: ~key.isin(*added))
    extra = F.create_map(*[part for name, x in added.items() for part in (F.lit(name), x.cast(value))])
    both = F.map_concat(given, extra)
    return df.withColumn("metadata", F.to_variant_object(both) if nested else both)


def assign_shard(df: DataFrame, key: str = "doc_id", shards: int = DOCUMENT_SHARDS) -> DataFrame:
    return df.withColumn("shard_id", shard_of(key, shards))


def check_shard(df: DataFrame, key: str = "doc_id", shards: int = DOCUMENT_SHARDS) -> DataFrame:
    """Add `error` where the given shard is not the one the key belongs to."""
    expected = shard_of(key, shards)
    message = F.concat(
        F.lit("Document assigned to wrong shard. Expected "),
        expected.cast("string"),
        F.lit(", got "),
        F.col("shard_id").cast("string"),
    )
    return df.withColumn("error", F.when(F.col("shard_id") != expected, message).otherwise(""))


def route_by_shard(df: DataFrame) -> DataFrame:
    """Group rows by shard for a partitioned write.

    There are only a few shards, so a plain repartition would leave all but a
    few tasks idle. The rebalance hint lets adaptive execution split each shard
    into tasks of the advisory size.
    """
    return df.hint("rebalance", F.col("shard_id"))


def accept(
    df: DataFrame,
    ingested_at,
    shards: int = DOCUMENT_SHARDS,
    max_chars: int = MAX_CONTENT_CHARS,
) -> DataFrame:
    """Validate, give ids, enrich and assign shards in one pass, writing nothing.

    Rejected rows stay in the frame with their reason and no shard.
    """
    checked = validate(df, max_chars)
    done = assign_shard(enrich(assign_doc_id(checked), ingested_at), shards=shards)
    kept = [F.when(F.col("valid"), F.col(c)).alias(c) for c in ("metadata", "shard_id")]
    rest = [c for c in done.columns if c not in ("metadata", "shard_id")]
    return done.select(*rest, *kept)


def dry_run(df: DataFrame, ingested_at, shards: int = DOCUMENT_SHARDS) -> DataFrame:
    """What `accept` would do with each document: verdict, id, shard and metadata."""
    done = accept(df, ingested_at, shards)
    return done.select(
        "valid",
        "error",
        F.when(F.col("valid"), F.col("doc_id")).alias("doc_id"),
        "shard_id",
        "metadata",
    )


def ingest_stats(validated: DataFrame) -> DataFrame:
    """Documents received, processed and failed, and UTF-8 bytes of accepted content."""
    return validated.agg(
        F.count("*").alias("documents_received"),
        F.count_if("valid").alias("documents_processed"),
        F.count_if(~F.col("valid")).alias("documents_failed"),
        F.coalesce(
            F.sum(F.when(F.col("valid"), F.octet_length("content"))), F.lit(0).cast("bigint")
        ).alias("bytes_processed"),
    )


def document_results(docs: DataFrame) -> DataFrame:
    """Per document, how many search tokens and suggestion terms its text gives.

    Stems are as many as the words they come from, and suggestion terms are the
    words of two letters and more, so each text is analyzed once, without stems.
    """
    counted = docs.withColumn("_words", preprocess(full_text(), stem=False))
    long = F.filter("_words", lambda w: F.length(w) >= 2)
    return counted.withColumns(
        {"tokens_processed": F.size("_words").cast("bigint"), "typeahead_terms": F.size(long).cast("bigint")}
    ).drop("_words")


def bulk_summary(results: DataFrame) -> DataFrame:
    """Totals of a bulk run per shard; `error` is "" for successful rows."""
    return results.groupBy("shard_id").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("error") == "").alias("successful"),
        F.count_if(F.col("error") != "").alias("failed"),
    )
