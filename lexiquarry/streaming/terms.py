"""Running term counts, counter syncs and signed updates over streams.

Frequencies lie in a stored table by shard and bucket of the term. A
micro-batch appends the new frequencies of the terms it names; every
`merge_after` batches the touched buckets are rewritten, so neither writing a
batch nor reading the table costs the whole history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexiquarry.functions.hashing import TERM_SHARDS
from lexiquarry.functions.text import full_text, typeahead_tokens
from lexiquarry.operators import stored_terms
from lexiquarry.operators.terms import KEY, assign_term_shard
from lexiquarry.sources import versions as v
from lexiquarry.streaming import log

# Fixed value: how often counters are synced to the stored table.
SYNC_EVERY = "30 seconds"
MERGE_AFTER = 8


def term_count_stream(docs: DataFrame, shards: int = TERM_SHARDS) -> DataFrame:
    """Running count per shard and term of a stream of documents."""
    tokens = docs.select(F.explode(typeahead_tokens(full_text())).alias("term"))
    counts = tokens.groupBy("term").agg(F.count("*").alias("frequency"))
    return assign_term_shard(counts, shards).select(*KEY, "frequency")


def update_count_stream(updates: DataFrame) -> DataFrame:
    """Running sum per shard and term of a stream of signed deltas."""
    return updates.groupBy(*KEY).agg(F.sum("frequency_delta").alias("frequency"))


def _run(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None,
    mode: str,
    merge_after: int,
    store: Callable[[DataFrame, dict[str, str]], v.Version],
) -> StreamingQuery:
    """Store each micro-batch once, and merge from time to time."""
    stored_terms.ensure_terms(rows.sparkSession, out)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if v.has_batch(v.read_version(spark, out), checkpoint, number):
            return
        version = store(batch, {v.batch_name(checkpoint): str(number)})
        if len(version.segments) >= merge_after:
            stored_terms.merge_terms(spark, out)

    return log.run(rows, write, checkpoint, every, mode=mode)


def start_counts(
    counts: DataFrame, out: str, checkpoint: str, every: str | None = None, merge_after: int = MERGE_AFTER
) -> StreamingQuery:
    """Store running counts as they change. A count or counter replaces the stored frequency; at zero or below the term is gone."""

    def store(batch: DataFrame, done: dict[str, str]) -> v.Version:
        spark = batch.sparkSession
        return stored_terms.write_frequencies(spark, out, v.read_version(spark, out), batch, **done)

    return _run(counts, out, checkpoint, every, "update", merge_after, store)


def sync_stream(
    counters: DataFrame, out: str, checkpoint: str, every: str | None = SYNC_EVERY, merge_after: int = MERGE_AFTER
) -> StreamingQuery:
    """Sync changed counters to the stored table on an interval."""
    return start_counts(counters, out, checkpoint, every, merge_after)


def update_stream(
    updates: DataFrame, out: str, checkpoint: str, every: str | None = None, merge_after: int = MERGE_AFTER
) -> StreamingQuery:
    """Apply each micro-batch of signed deltas to the stored table under `out`.

    Same rule as a buffered batch: known terms move and go at zero or below,
    unknown ones need a positive sum. Only buckets of its terms are read.
    """

    def store(batch: DataFrame, done: dict[str, str]) -> v.Version:
        return stored_terms.apply_deltas(batch.sparkSession, out, batch, **done)

    return _run(updates, out, checkpoint, every, "append", merge_after, store)


def current_frequencies(spark: SparkSession, out: str) -> DataFrame:
    """The last frequency of each term, removed ones left out."""
    return stored_terms.open_terms(spark, out)


def seed_frequencies(terms: DataFrame, out: str) -> None:
    """Start a table from a stored snapshot."""
    stored_terms.create_terms(terms, out)
