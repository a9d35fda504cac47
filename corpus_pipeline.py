"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before has kept, as a table read from Parquet,
and returns documents with the same columns; the last returns the pieces of
packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.llm import decontamination, language, line_dedup, packing, simhash
from lexiquarry.llm.rows import settle, spread_rows, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; the others go."""
    names, prototypes = language.fit(docs.where(language.learns()))
    found = language.identify(spread_rows(docs), names, prototypes)
    return found.where(language.accepted()).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier place has alike; their length is counted anew."""
    found = line_dedup.dedup_lines(spread_rows(docs), short=True)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicate(spread_rows(docs), shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark phrases; the others go."""
    found = decontamination.decontaminate(spread_rows(docs), table(spark, sf_dir, "benchmark"))
    return found.where(~decontamination.contaminated()).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens."""
    import public_tokenizers

    pieces = packing.token_pieces(spread_rows(docs), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# No stage can be said in SQL as a whole; tests hold each against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
