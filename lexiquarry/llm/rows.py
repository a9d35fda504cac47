"""Running a numpy function over the texts of a table, batch by batch.

Rows stay where they are: no operator built on `per_text` shuffles. A batch is
cut into pieces of bounded bytes (one text is never cut), so memory does not
follow the size of a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiquarry.session import discard, lookup_side, settle

__all__ = ["discard", "lookup_side", "per_text", "raw_bytes", "settle", "spread_rows", "table"]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts in one array, and where each begins (one more at the end). Null: empty."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, texts: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most so many bytes of text, or one row."""
    ends = raw_bytes(batch.column(texts))[1][1:]
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def per_text(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    fields: str,
    text: str = "text",
    keep: list[str] | None = None,
    piece_bytes: int = 4 << 20,
) -> DataFrame:
    """The kept columns of each row and what a function of its text gives.

    `make` runs once in each task and returns that function, which takes an
    Arrow array of texts and returns an array for each of `fields` (a DDL
    schema). A kept column that has the name of a field is replaced by it.
    """
    out = T.StructType.fromDDL(fields)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in out.names]
    plain = docs.select(
        *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)),
        F.col(f"`{text}`").cast("string").alias("t"),
    )
    kept = plain.drop("t").schema
    schema = T.StructType(kept.fields + [T.StructField(f"f{i}", f.dataType) for i, f in enumerate(out)])

    def run(batches):
        of = make()
        for batch in batches:
            for piece in pieces(batch, "t", piece_bytes):
                arrays = of(piece.column("t"))
                names = [f"k{i}" for i in range(len(keep))] + [f"f{i}" for i in range(len(arrays))]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *arrays], names)

    got = plain.mapInArrow(run, schema)
    return got.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)),
        *(F.col(f"f{i}").alias(f.name) for i, f in enumerate(out)),
    )


SPLIT_BYTES = 128 << 20  # of a file that a task reads, about


def spread_rows(scan: DataFrame) -> DataFrame:
    """Deal the rows of a small table of one or few files to several tasks.

    A table with as many files as there are cores, or with enough bytes for as
    many splits, stays as it is: nothing large is moved. Only names and lengths
    of files are looked at.
    """
    spark = scan.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if len(scan.inputFiles()) >= cores or size >= cores * SPLIT_BYTES:
        return scan
    return scan.repartition(4 * cores)
