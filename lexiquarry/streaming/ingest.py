"""Continuous ingest: validate, enrich, give shards, publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from lexiquarry.operators.ingest import accept, split_valid
from lexiquarry.session import settle
from lexiquarry.sources.messages import DOCUMENT_TOPIC, document_messages, publish
from lexiquarry.streaming import log


def ingest_stream(raw: DataFrame, ingested_at: Column) -> DataFrame:
    """The batch plan over a stream of raw documents; it keeps no state."""
    return accept(raw, ingested_at)


def start_ingest(
    raw: DataFrame,
    ingested_at: Column,
    out: str,
    checkpoint: str,
    every: str | None = None,
    folder: str | None = None,
    **kafka: str,
) -> StreamingQuery:
    """Publish accepted documents to the document topic and keep rejected rows under `out`/rejected.

    The topic is a Kafka topic or, with `folder`, a folder of messages, as
    `read_document_stream` takes them. A replayed batch replaces its messages in
    a folder; to Kafka it may send them again, which upserts don't mind.
    """
    log.start_log(raw.sparkSession, f"{out}/rejected", ingest_stream(raw, ingested_at).schema)

    def write(batch: DataFrame, number: int) -> None:
        # Validated and enriched once for both.
        accepted, rejected = split_valid(settle(batch, "ingested"))
        publish(document_messages(accepted), DOCUMENT_TOPIC, folder, f"batch-{number}", **kafka)
        log.append(rejected, f"{out}/rejected", number)

    return log.run(ingest_stream(raw, ingested_at), write, checkpoint, every)
