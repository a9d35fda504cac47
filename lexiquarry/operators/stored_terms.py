"""Term frequencies on disk, by shard and bucket of the term, changed by small batches.

A batch stores the new frequencies of the terms it names as a segment; zero
stands for a removed term. To move a frequency, it reads the buckets of these
terms and the few segments not merged yet. `merge_terms` rewrites the buckets
that segments touch.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.operators.index import TERM_BUCKETS, term_bucket
from lexiquarry.operators.terms import KEY
from lexiquarry.session import lookup_side
from lexiquarry.sources import versions as v

TABLE, BUCKET = "frequencies", "term_bucket"
SCHEMA = "term string, frequency bigint, shard_id int"


def create_terms(terms: DataFrame, root: str, buckets: int = TERM_BUCKETS) -> DataFrame:
    """Store frequencies under a new folder; (shard_id, term) is unique."""
    spark = terms.sparkSession
    version = v.Version(0, settings={"buckets": str(buckets)})
    rows = terms.select(*KEY, "frequency").withColumn(BUCKET, term_bucket(buckets))
    version.parts.update(v.write_parts(rows, root, TABLE, BUCKET, ["term"]))
    v.publish(spark, root, version)
    return open_terms(spark, root)


def ensure_terms(spark: SparkSession, root: str) -> None:
    """Make an empty table if there is none."""
    if not v.versions(spark, root):
        create_terms(spark.createDataFrame([], SCHEMA), root)


def _last(spark: SparkSession, root: str, version: v.Version, only=None) -> DataFrame | None:
    """The last frequency of each term that segments name."""
    pieces = v.read_segments(spark, root, version, TABLE, SCHEMA)
    if pieces is None:
        return None
    pieces = pieces.withColumn(BUCKET, term_bucket(int(version.settings["buckets"])))
    if only is not None:
        pieces = pieces.where(v.within(only, BUCKET))
    return pieces.groupBy(*KEY, BUCKET).agg(F.max_by("frequency", "segment").alias("frequency"))


def _rows(spark: SparkSession, root: str, version: v.Version, only=None) -> DataFrame:
    base = v.read_parts(spark, root, version, TABLE, SCHEMA, BUCKET, only)
    late = _last(spark, root, version, only)
    if late is None:
        return base
    late = lookup_side(late)
    return base.join(late.select(*KEY), KEY, "left_anti").unionByName(late.select(base.columns)).where("frequency > 0")


def open_terms(spark: SparkSession, root: str, version: v.Version | None = None) -> DataFrame:
    """(shard_id, term, frequency) as of a version, by default the last; removed terms are left out."""
    return _rows(spark, root, version or v.read_version(spark, root)).select(*KEY, "frequency")


def stored(spark: SparkSession, root: str, version: v.Version, keys: DataFrame) -> DataFrame:
    """Frequencies of these terms; other buckets are not opened."""
    only = v.touched(keys.withColumn(BUCKET, term_bucket(int(version.settings["buckets"]))), BUCKET)
    return _rows(spark, root, version, only).join(keys.select(*KEY), KEY, "left_semi").select(*KEY, "frequency")


def write_frequencies(spark: SparkSession, root: str, version: v.Version, rows: DataFrame, **settings: str) -> v.Version:
    """Replace the frequencies of the rows' terms, each of which is there once; at zero or below a term goes."""
    name, folder = v.new_segment(root)
    shown = F.greatest(F.col("frequency"), F.lit(0).cast("bigint")).alias("frequency")
    rows.select("term", shown, "shard_id").write.parquet(f"{folder}/{TABLE}")
    return v.publish(spark, root, version.with_segment(name, **settings))


def apply_deltas(spark: SparkSession, root: str, deltas: DataFrame, **settings: str) -> v.Version:
    """Move frequencies by signed deltas (shard_id, term, frequency_delta), summed by term.

    Known terms go at zero or below; unknown ones need a positive sum.
    """
    version = v.read_version(spark, root)
    moved = lookup_side(deltas.groupBy(*KEY).agg(F.sum("frequency_delta").alias("_delta")))
    known = stored(spark, root, version, moved)
    zero = F.lit(0).cast("bigint")
    rows = moved.join(known, KEY, "left").select(*KEY, (F.coalesce("frequency", zero) + F.col("_delta")).alias("frequency"))
    return write_frequencies(spark, root, version, rows, **settings)


def merge_terms(spark: SparkSession, root: str) -> v.Version:
    """Write the buckets that segments touch anew; others stay as they are."""
    version = v.read_version(spark, root)
    if not version.segments:
        return version
    only = v.touched(_last(spark, root, version), BUCKET)
    written = v.write_parts(_rows(spark, root, version, only), root, TABLE, BUCKET, ["term"])
    old = {part: gen for part, gen in version.parts.items() if part[1:] not in only}
    return v.publish(spark, root, replace(version, number=version.number + 1, parts={**old, **written}, segments=()))
