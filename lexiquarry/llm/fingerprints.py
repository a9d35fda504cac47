"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash below a fixed fraction of the hash
range. So it grows with the text, the sketch of a union is the union of the
sketches, and the share of one sketch found in another estimates the share of
one text's shingles found in the other, however unequal the two are.

`compare_next` sets each document against the next by descending key and
against an edited form of itself. The rows are dealt once by ranges of the key,
whose bounds come from a sample of keys, and each range ends with a copy of the
first row of the next: that moves each text once and stores none.

Defined cases: null text is empty. A text of fewer words than a shingle has one
shingle, a text without words none. A text none of whose hashes is kept is like
another only if the texts are equal. Rows with equal keys come in the order of
their texts; null keys come last. The last row's next is the first; a single
row's next is itself.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiquarry.llm.rows import lookup_side, per_text, settle
from lexiquarry.llm.words import shingle_hashes, words_of

SHINGLE = 5
SCALE_BITS = 2  # one hash in 2^2 is kept
LOT = 2 << 20  # characters handled at a time


def sketches(texts: list[str], shingle: int = SHINGLE, scale_bits: int = SCALE_BITS) -> list[np.ndarray]:
    """Sorted distinct kept hashes of each text, as 32 bits."""
    words = words_of(pa.array(texts, pa.large_string()))
    hashes, owner = shingle_hashes(words.hashes(), words.text, shingle)
    kept = hashes <= np.uint64((1 << (64 - scale_bits)) - 1)
    values = (hashes[kept] >> np.uint64(32 - scale_bits)).astype(np.int64)
    distinct = np.unique(owner[kept] << 32 | values)
    ends = np.searchsorted(distinct >> 32, np.arange(len(texts) + 1))
    values = (distinct & 0xFFFFFFFF).astype("<u4")
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def written(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def merged(a: str, b: str) -> str:
    """The fingerprint of two texts' shingles together."""
    return written(np.union1d(read(a), read(b)))


def containment(a: np.ndarray, b: np.ndarray, equal: bool) -> float:
    """The share of a found in b; without any kept hash, whether the texts are equal."""
    if equal:
        return 1.0
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def jaccard(a: np.ndarray, b: np.ndarray, equal: bool) -> float:
    if equal:
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (default all) and the fingerprint of each text."""

    def make():
        def of(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([written(s) for s in sketches([t or "" for t in texts.to_pylist()])])]

        return of

    return per_text(docs, make, "fingerprint string", text, keep, LOT)


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by as many first ones of the following text, or all it has."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def compared(texts: list[str], following: list[str]) -> list[list]:
    """The result columns of texts and the texts that follow them."""
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    distinct = list(dict.fromkeys([*texts, *following]))
    own = dict(zip(distinct, sketches(distinct), strict=True))
    new = sketches(changed)
    rows = []
    for a, b, c, n in zip(texts, following, changed, new, strict=True):
        s, f = own[a], own[b]
        rows.append(
            (
                len(a),
                hashlib.sha256(c.encode()).hexdigest(),
                written(s),
                written(n),
                containment(s, n, a == c),
                containment(s, f, a == b),
                jaccard(s, n, a == c),
                jaccard(s, f, a == b),
            )
        )
    return [list(x) for x in zip(*rows, strict=True)]


RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, jaccard_edited double, jaccard_next double"
)
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
SAMPLE_KEYS = 10_000  # keys that the bounds of the ranges are chosen from


def bounds(rows: DataFrame, parts: int, sample: int = SAMPLE_KEYS) -> list:
    """At most parts - 1 ascending keys that cut the rows into ranges of about equal count."""
    many = max(rows.count(), 1)
    thin = rows.where(F.shiftrightunsigned(F.xxhash64("key"), 32) < int(min(1.0, 2 * sample / many) * 2**32))
    keys = thin.where("key is not null").select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(sample)
    found = sorted(r["key"] for r in keys.collect())
    return sorted({found[len(found) * k // parts] for k in range(1, parts)}) if found else []


def ranged(rows: DataFrame, cuts: list) -> DataFrame:
    """With `part`, the number of the range a row's key is in; later for smaller keys, last for null."""

    @F.pandas_udf("long")
    def part(keys: pd.Series) -> pd.Series:
        at = [len(cuts) + 1 if k is None or k != k else len(cuts) - bisect.bisect_right(cuts, k) for k in keys]
        return pd.Series(at, dtype="int64")

    return rows.withColumn("part", part("key"))


def compare_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: key, length, fingerprints of the text and its edited form, and how much of it is in these and the next."""
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = ranged(plain, bounds(plain, 4 * tasks))
    # The first row of each range, which the last of the range before is set against: one row a range.
    place = F.struct(F.col("key").isNotNull().alias("known"), "key")
    last_place = rows.groupBy("part").agg(F.max(place).alias("top"))
    last_place = lookup_side(last_place.select(F.col("part").alias("of"), F.col("top.key").alias("top")))
    first = rows.join(last_place, (F.col("part") == F.col("of")) & F.col("key").eqNullSafe(F.col("top")))
    heads = settle(first.groupBy("part").agg(F.min("text").alias("text")), "heads")
    # At most four times as many numbers as there are tasks.
    parts = [r["part"] for r in heads.select("part").orderBy("part").collect()]
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "here long, part long")
    ends = after.join(heads, "part").select(F.lit(None).cast(plain.schema["key"].dataType).alias("key"), "text", F.col("here").alias("part"), F.lit(True).alias("end"))
    both = rows.select("key", "text", "part", F.lit(False).alias("end")).unionByName(ends)
    dealt = both.repartition(tasks, "part").sortWithinPartitions("part", "end", F.desc_nulls_last("key"), "text")
    result = T.StructType.fromDDL(RESULT)
    schema = T.StructType([T.StructField("key", plain.schema["key"].dataType), *result.fields])

    def run(batches: Iterator[pa.RecordBatch]):
        held: tuple | None = None  # the row whose next has not come yet
        for batch in batches:
            kind = batch.column("key").type
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            parts, ends = batch.column("part").to_pylist(), batch.column("end").to_pylist()
            pairs: list[tuple] = []
            size = 0
            for row in zip(keys, texts, parts, ends, strict=True):
                if held is not None and not held[3]:
                    pairs.append((held[0], held[1], row[1]))
                    size += len(held[1])
                held = row
                if size > LOT:
                    yield made(pairs, kind)
                    pairs, size = [], 0
            if pairs:
                yield made(pairs, kind)

    def made(pairs: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        keys, texts, following = (list(x) for x in zip(*pairs, strict=True))
        arrays = [pa.array(c, t) for c, t in zip(compared(texts, following), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *arrays], schema.names)

    found = dealt.select("key", "text", "part", "end").mapInArrow(run, schema)
    return found.select(F.col("key").alias(key), *result.names)
