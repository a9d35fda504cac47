"""Document and term tables on shared storage, and in a database over JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions.hashing import document_bucket


def write_documents(docs: DataFrame, path: str) -> None:
    """Write documents by shard and bucket of the id, sorted by id, in files of even size.

    The rebalance hint splits a shard's bucket that is too large.
    """
    laid_out = (
        docs.withColumn("doc_bucket", document_bucket("doc_id"))
        .hint("rebalance", F.col("shard_id"), F.col("doc_bucket"))
        .sortWithinPartitions("shard_id", "doc_bucket", "doc_id")
    )
    laid_out.write.partitionBy("shard_id", "doc_bucket").parquet(path)


def read_documents(spark: SparkSession, path: str, shard_id: int | None = None) -> DataFrame:
    """Documents as stored; `doc_bucket` lets lookups by id open the directories of these ids only."""
    docs = spark.read.parquet(path)
    return docs if shard_id is None else docs.where(F.col("shard_id") == shard_id)


def scan_documents(docs: DataFrame, shard_id: int | None = None) -> DataFrame:
    """Id and text of the documents of a shard (or of all); NULL text becomes empty.

    On a table written by `write_documents` the shard is a partition, so other
    shards are not opened.
    """
    if shard_id is not None:
        docs = docs.where(F.col("shard_id") == shard_id)
    return docs.select(
        "doc_id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("content", F.lit("")).alias("content"),
    )


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write a new table in files by hash of the keys, so that joins and groups on them need no shuffle when it is read by `read_bucketed`."""
    name = f"written_{uuid.uuid4().hex}"
    spread = df.repartition(buckets, *keys)
    spread.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    # Only the entry in the catalog goes: the files belong to the path.
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int) -> DataFrame:
    """A table written by `write_bucketed` with the same keys and number of buckets."""
    name = f"read_{uuid.uuid4().hex}"
    columns, location = ", ".join(keys), path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({columns}) INTO {buckets} BUCKETS LOCATION '{location}'")
    table = spark.table(name)
    table.schema  # noqa: B018 (resolves the files, after which the entry is not needed)
    spark.sql(f"DROP TABLE {name}")
    return table


def write_terms(terms: DataFrame, path: str) -> None:
    """Write a term snapshot by shard, sorted by term so that prefix filters skip data."""
    laid_out = terms.hint("rebalance", F.col("shard_id")).sortWithinPartitions("shard_id", "term")
    laid_out.write.partitionBy("shard_id").parquet(path)


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table. Pass partitionColumn, lowerBound, upperBound and
    numPartitions to read it in parallel; without them one task reads it all."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()
