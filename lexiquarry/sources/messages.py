"""JSON payloads and topics: documents and term updates, in batch and as streams.

A topic is a Kafka topic or, for tests and replays, a folder of JSON lines with
the same `key` and `value` fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.operators.ingest import MAX_CONTENT_CHARS, validate_json
from lexiquarry.schema import DOCUMENT_MESSAGE, NESTED_DOCUMENT_MESSAGE, TERM_UPDATE_MESSAGE
from lexiquarry.session import settle

# Topics, the action of a term update, and bulk payload errors.
DOCUMENT_TOPIC = "document_indexing"
TERM_TOPIC = "typeahead_updates"
UPDATE_ACTION = "update_terms"
ARRAY_REQUIRED = "Documents array is required"
ARRAY_TYPE = "Documents must be an array"
ARRAY_EMPTY = "No documents provided"

MESSAGE = "key string, value string, timestamp timestamp, offset bigint"
TERMS_PER_MESSAGE = 1000


def read_json_documents(
    spark: SparkSession, path: str, max_chars: int = MAX_CONTENT_CHARS, nested: bool = False
) -> DataFrame:
    """JSON document payloads, one per line, parsed and validated.

    Malformed lines stay as rejected rows with their text. With `nested`,
    metadata is a VARIANT.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "payload")
    return validate_json(lines, max_chars=max_chars, nested=nested)


def explode_bulk(bulk: DataFrame, payload: str = "payload", empty_error: str = ARRAY_EMPTY) -> DataFrame:
    """One row per document of `{"documents": [...]}` payloads, in `position` order.

    The document is JSON text for `validate_json`. A payload without a usable
    array gives one row with `error`.
    """
    array = F.try_variant_get(F.try_parse_json(payload), "$.documents", "variant")
    kind = F.split_part(F.schema_of_variant(array), F.lit("<"), F.lit(1))
    items = F.from_json(F.get_json_object(payload, "$.documents"), "array<string>")
    rows = bulk.select("*", kind.alias("_kind"), items.alias("_items")).withColumn(
        "error",
        F.when(F.col("_kind").isNull(), ARRAY_REQUIRED)
        .when(F.col("_kind") != "ARRAY", ARRAY_TYPE)
        .when(F.size("_items") == 0, empty_error)
        .otherwise(""),
    )
    usable = F.when(F.col("error") == "", F.col("_items"))
    kept = [c for c in bulk.columns if c != payload]
    return rows.select(*kept, "error", F.posexplode_outer(usable).alias("position", "document"))


def document_messages(docs: DataFrame) -> DataFrame:
    """Documents as messages keyed by their shard. VARIANT metadata is written as the JSON it holds."""
    body = F.struct(
        F.col("doc_id").alias("id"), "title", "content", "source", "metadata", "shard_id"
    )
    return docs.select(
        F.concat(F.lit("shard-"), F.col("shard_id").cast("string")).alias("key"),
        F.to_json(body).alias("value"),
    )


def term_update_messages(counts: DataFrame, terms_per_message: int = TERMS_PER_MESSAGE) -> DataFrame:
    """Term counts as update messages of about `terms_per_message` terms each.

    `counts` has one row per shard and term. A shard's terms are cut into
    messages by a hash, so no row ever holds the vocabulary of a whole shard.
    """
    counts = settle(counts.select("shard_id", "term", "frequency"), "counts")
    # One row per shard.
    sizes = F.broadcast(counts.groupBy("shard_id").agg(F.count("*").alias("_n")))
    parts = F.ceil(F.col("_n") / terms_per_message)
    cut = counts.join(sizes, "shard_id").withColumn("_part", F.pmod(F.xxhash64("term"), parts))
    messages = cut.groupBy("shard_id", "_part").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "frequency"))).alias("terms")
    )
    body = F.struct(F.lit(UPDATE_ACTION).alias("action"), "shard_id", "terms")
    return messages.select(
        F.concat(F.lit("shard-"), F.col("shard_id").cast("string")).alias("key"),
        F.to_json(body).alias("value"),
    )


def publish(messages: DataFrame, topic: str, folder: str | None = None, part: str | None = None, **kafka: str) -> None:
    """Send a batch of messages to a Kafka topic, or append them to a folder with the time and an offset.

    A `part` names the batch: sent to a folder again, it replaces itself.
    """
    if folder is None:
        messages.write.format("kafka").option("topic", topic).options(**kafka).save()
        return
    placed = messages.select(
        "key", "value", F.current_timestamp().alias("timestamp"), F.monotonically_increasing_id().alias("offset")
    )
    if part is None:
        placed.write.mode("append").json(f"{folder}/{topic}")
    else:
        placed.write.mode("overwrite").json(f"{folder}/{topic}/{part}")


def publish_documents(docs: DataFrame, folder: str | None = None, **kafka: str) -> None:
    publish(document_messages(docs), DOCUMENT_TOPIC, folder, **kafka)


def publish_term_updates(counts: DataFrame, folder: str | None = None, **kafka: str) -> None:
    publish(term_update_messages(counts), TERM_TOPIC, folder, **kafka)


def read_messages(spark: SparkSession, topic: str, folder: str | None = None, **kafka: str) -> DataFrame:
    """Stream of a topic's messages, with their order `seq`: time, then offset.

    Messages of one key are in one partition of a topic, so their order is total.
    """
    if folder is not None:
        reader = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", kafka.pop("files", "1000"))
        stream = reader.option("recursiveFileLookup", "true").json(f"{folder}/{topic}")
    else:
        stream = spark.readStream.format("kafka").option("subscribe", topic).options(**kafka).load()
    return stream.select(
        F.col("key").cast("string"), F.col("value").cast("string"), F.struct("timestamp", "offset").alias("seq")
    )


def parse_documents(messages: DataFrame, nested: bool = False) -> DataFrame:
    """The documents of messages, with `seq` where the messages have it; with `nested`, metadata is a VARIANT."""
    order = ["seq"] if "seq" in messages.columns else []
    body = F.from_json("value", NESTED_DOCUMENT_MESSAGE if nested else DOCUMENT_MESSAGE)
    return messages.select(body.alias("d"), *order).select(
        F.col("d.id").alias("doc_id"), "d.title", "d.content", "d.source", "d.metadata", "d.shard_id", *order
    )


def parse_term_updates(messages: DataFrame) -> DataFrame:
    """One signed delta per term of each update message."""
    body = F.from_json("value", TERM_UPDATE_MESSAGE)
    deltas = messages.select(body.alias("m")).select(
        "m.shard_id", F.explode_outer("m.terms").alias("term", "frequency_delta")
    )
    return deltas.where("term is not null")


def read_document_stream(
    spark: SparkSession, folder: str | None = None, nested: bool = False, **kafka: str
) -> DataFrame:
    return parse_documents(read_messages(spark, DOCUMENT_TOPIC, folder, **kafka), nested)


def read_term_update_stream(spark: SparkSession, folder: str | None = None, **kafka: str) -> DataFrame:
    return parse_term_updates(read_messages(spark, TERM_TOPIC, folder, **kafka))
