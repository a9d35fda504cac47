"""Append-only tables written by micro-batch.

Each micro-batch owns the folder `batch_id=<n>`. Writing it again replaces it,
so a replayed batch leaves the table as it was. A later batch supersedes the rows of
an earlier one with the same key. Nothing stored is rewritten, so writing a batch
costs what the batch is long; `compact` starts over once reading gets slow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexiquarry.session import lookup_side


def start_log(spark: SparkSession, path: str, schema: T.StructType | str) -> None:
    """Make sure the table can be read before its first batch; one that is there stays."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch_id=-1")


def append(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")


def read_log(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Rows of all batches, or of those before a batch, with their `batch_id`."""
    rows = spark.read.option("basePath", path).parquet(path)
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return rows if before is None else rows.where(F.col("batch_id") < before)


def latest(rows: DataFrame, keys: list[str], **extra: Column) -> DataFrame:
    """The rows of the last batch of each key, with `extra` aggregates over all its batches.

    Only keys with more than one version need a look at the others. They are
    found on the narrow key columns, so wide rows are not shuffled while such
    keys are few. `extra` columns are NULL for keys with one version.
    """
    aggregates = [value.alias(name) for name, value in extra.items()]
    several = (
        rows.groupBy(*keys)
        .agg(F.max("batch_id").alias("_last"), F.count("*").alias("_n"), *aggregates)
        .where("_n > 1")
        .drop("_n")
    )
    several = lookup_side(several).withColumnsRenamed({k: f"_{k}" for k in keys})
    # Null keys are keys, too.
    same = [rows[k].eqNullSafe(several[f"_{k}"]) for k in keys]
    joined = rows.join(several, same, "left").drop(*(f"_{k}" for k in keys))
    last = F.col("_last").isNull() | (F.col("batch_id") == F.col("_last"))
    return joined.where(last).drop("_last", "batch_id")


def compact(spark: SparkSession, path: str, keys: list[str], into: str) -> None:
    """Start a new table from the last rows of each key of an old one."""
    append(latest(read_log(spark, path), keys), into, -1)


def run(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Start a query that hands each micro-batch to `write`.

    With `every` it runs on that interval; without, it works off what there is
    and ends.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )
