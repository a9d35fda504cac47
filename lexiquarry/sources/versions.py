"""Tables that change on disk in small steps, under a list of versions.

The rows of a table lie in partitions `<root>/<table>/shard_id=<s>/<bucket>=<b>/gen=<g>`.
A change is stored as a segment, a folder of small tables `<root>/segments/<name>/<table>`,
with the keys whose earlier rows it replaces in its table `gone`. Merging rewrites the
partitions that segments touch as a new generation and leaves all others as they are.

A version says which generation of each partition and which segments count. It is one
file, written last and never again, so readers see a change whole or not at all, and a
reader of an older version keeps what it reads until `drop_unused`. One writer at a
time: a second one that started from the same version fails when it publishes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiquarry.session import freed_shuffles, list_paths, lookup_side, remove_folder

KEY = ["shard_id", "doc_id"]
GONE = "shard_id int, doc_id string"

# A batch keeps what it replaces until the next merge, so stored tables are packed tighter than by Spark's default.
CODEC = "zstd"

_ROWS = "kind string, name string, shard_id int, bucket int, value string"


@dataclass(frozen=True)
class Version:
    number: int
    parts: dict[tuple[str, int, int], str] = field(default_factory=dict)  # (table, shard, bucket) -> generation
    segments: tuple[str, ...] = ()  # from the oldest to the newest
    settings: dict[str, str] = field(default_factory=dict)

    def with_segment(self, name: str, **settings: str) -> Version:
        return replace(
            self, number=self.number + 1, segments=(*self.segments, name), settings={**self.settings, **settings}
        )


def _folder(root: str, number: int) -> str:
    return f"{root}/versions/number={number:09d}"


def publish(spark: SparkSession, root: str, version: Version) -> Version:
    """Make a version the current one."""
    rows = [("part", table, shard, bucket, gen) for (table, shard, bucket), gen in version.parts.items()]
    rows += [("segment", name, None, place, None) for place, name in enumerate(version.segments)]
    rows += [("setting", name, None, None, value) for name, value in version.settings.items()]
    spark.createDataFrame(rows, _ROWS).coalesce(1).write.parquet(_folder(root, version.number))
    return version


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that are there, the current one last; none of a table that was never published."""
    found = list_paths(spark, f"{root}/versions/number=*/_SUCCESS")
    return sorted(int(re.search(r"number=(\d+)/_SUCCESS$", path)[1]) for path in found)


def read_version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version, by default the one published last."""
    if number is None:
        known = versions(spark, root)
        if not known:
            raise FileNotFoundError(f"no version of a table at {root}")
        number = known[-1]
    # As many rows as there are partitions.
    rows = spark.read.schema(_ROWS).parquet(_folder(root, number)).collect()
    segments = sorted((r["bucket"], r["name"]) for r in rows if r["kind"] == "segment")
    return Version(
        number,
        {(r["name"], r["shard_id"], r["bucket"]): r["value"] for r in rows if r["kind"] == "part"},
        tuple(name for _, name in segments),
        {r["name"]: r["value"] for r in rows if r["kind"] == "setting"},
    )


def write_parts(rows: DataFrame, root: str, table: str, bucket: str, order: list[str]) -> dict[tuple[str, int, int], str]:
    """Write rows (with shard_id and the bucket column) as a new generation of the partitions they fall in.

    The rebalance hint splits a partition that is too large for a task. The
    generation is named after the shuffle, which need not carry it.
    """
    gen = uuid.uuid4().hex
    spark = rows.sparkSession
    laid_out = (
        rows.hint("rebalance", F.col("shard_id"), F.col(bucket))
        .sortWithinPartitions("shard_id", bucket, *order)
        .withColumn("gen", F.lit(gen))
    )
    with freed_shuffles(spark):
        laid_out.write.mode("append").partitionBy("shard_id", bucket, "gen").parquet(f"{root}/{table}", compression=CODEC)
    found = list_paths(spark, f"{root}/{table}/shard_id=*/{bucket}=*/gen={gen}")
    places = [re.search(rf"shard_id=(-?\d+)/{bucket}=(\d+)/gen=", path) for path in found]
    return {(table, int(p[1]), int(p[2])): gen for p in places}


def read_parts(
    spark: SparkSession,
    root: str,
    version: Version,
    table: str,
    schema: T.StructType | str,
    bucket: str,
    only: Iterable[tuple[int, int]] | None = None,
) -> DataFrame:
    """Rows of the table's partitions, with the bucket column; `only` names the (shard, bucket) pairs to read."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType(
        [f for f in schema.fields if f.name != "shard_id"]
        + [T.StructField("shard_id", T.IntegerType()), T.StructField(bucket, T.IntegerType()), T.StructField("gen", T.StringType())]
    )
    wanted = None if only is None else set(only)
    paths = [
        f"{root}/{table}/shard_id={s}/{bucket}={b}/gen={gen}"
        for (name, s, b), gen in sorted(version.parts.items())
        if name == table and (wanted is None or (s, b) in wanted)
    ]
    if not paths:
        return spark.createDataFrame([], full).drop("gen")
    return spark.read.schema(full).option("basePath", f"{root}/{table}").parquet(*paths).drop("gen")


def new_segment(root: str, name: str | None = None) -> tuple[str, str]:
    """Name and folder of a segment to be written; nothing counts until it is published."""
    name = f"{name or 'change'}-{uuid.uuid4().hex}"
    return name, f"{root}/segments/{name}"


def write_segment(rows: DataFrame, folder: str, table: str) -> None:
    """Write a table of a segment."""
    with freed_shuffles(rows.sparkSession):
        rows.write.parquet(f"{folder}/{table}", compression=CODEC)


def read_segments(spark: SparkSession, root: str, version: Version, table: str, schema: T.StructType | str) -> DataFrame | None:
    """Rows of a table of all segments, `segment` being the place of theirs from 1; None if there are none."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not version.segments:
        return None
    root = root.rstrip("/")
    full = T.StructType([*schema.fields, T.StructField("name", T.StringType())])
    # The folder tells the segment; one scan reads them all.
    paths = [f"{root}/segments/{name}/{table}" for name in version.segments]
    rows = spark.read.schema(schema).parquet(*paths)
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/segments/([^/]+)/{table}/", 1)
    places = F.create_map(*(F.lit(x) for k, name in enumerate(version.segments) for x in (name, k + 1)))
    return rows.select(*[f.name for f in full.fields[:-1]], F.element_at(places, folder).alias("segment"))


def batch_name(checkpoint: str) -> str:
    """The setting that records the last micro-batch of the stream with this checkpoint."""
    return f"batch of {checkpoint}"


def has_batch(version: Version, checkpoint: str, number: int) -> bool:
    """Whether a micro-batch is in a version; a replayed one is left out by this."""
    return int(version.settings.get(batch_name(checkpoint), "-1")) >= number


def batches(version: Version) -> dict[str, str]:
    """The last micro-batch of each stream that writes the table."""
    return {k: n for k, n in version.settings.items() if k.startswith(batch_name(""))}


def replaced(spark: SparkSession, root: str, version: Version) -> DataFrame | None:
    """Keys that segments replace, with the last segment that does; None if there are no segments."""
    gone = read_segments(spark, root, version, "gone", GONE)
    if gone is None:
        return None
    return lookup_side(gone.groupBy(*KEY).agg(F.max("segment").alias("last")))


def live(
    base: DataFrame, pieces: DataFrame | None, gone: DataFrame | None, keys: DataFrame | None = None
) -> DataFrame:
    """The rows that count: those of the base and of segments (column `segment`) that no later segment replaces.

    With `keys` only theirs. Which rows count is told from the keys alone; whole rows are then met with
    the replaced ones or with the wanted ones, which are mostly few, so that they need no shuffle.
    """
    if gone is None and keys is None:
        return base
    rows = base.withColumn("segment", F.lit(0))
    if pieces is not None:
        rows = rows.unionByName(pieces.select(*rows.columns))
    place = [*KEY, "segment"]
    if keys is None:
        dead = rows.select(*place).join(gone, KEY).where("segment < last").select(*place)
        return rows.join(lookup_side(dead), place, "left_anti").drop("segment")
    wanted = rows.select(*place).join(keys.select(*KEY), KEY, "left_semi")
    if gone is not None:
        wanted = live_pieces(wanted, gone).select(*place)
    return rows.join(lookup_side(wanted), place, "left_semi").drop("segment")


def live_pieces(pieces: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of segments that no later segment replaces."""
    return pieces.join(gone, KEY, "left").where("last IS NULL OR segment >= last")


def touched(rows: DataFrame, bucket: str) -> set[tuple[int, int]]:
    """The (shard, bucket) pairs of rows; at most as many as there are partitions."""
    return {(r[0], r[1]) for r in rows.select("shard_id", bucket).distinct().collect()}


def by_shard(pairs: Iterable[tuple[int, int]]) -> list[set[tuple[int, int]]]:
    """(shard, bucket) pairs, a set for each shard.

    Partitions are rewritten shard by shard: rows take more room while they are
    shuffled than in files, and so only those of one shard take it at a time.
    """
    shards: dict[int, set[tuple[int, int]]] = {}
    for shard, bucket in sorted(pairs):
        shards.setdefault(shard, set()).add((shard, bucket))
    return list(shards.values())


def within(only: set[tuple[int, int]], bucket: str) -> Column:
    """Whether a row is in one of the partitions; prunes scans by their folders."""
    shards: dict[int, list[int]] = {}
    for shard, b in sorted(only):
        shards.setdefault(shard, []).append(b)
    condition = F.lit(False)
    for shard, buckets in shards.items():
        condition = condition | ((F.col("shard_id") == shard) & F.col(bucket).isin(buckets))
    return condition


def drop_unused(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete what only versions before the last `keep` read; for when no reader is left on them."""
    numbers = versions(spark, root)
    old, kept = numbers[: -max(keep, 1)], numbers[-max(keep, 1) :]
    used_parts, used_segments = set(), set()
    for number in kept:
        version = read_version(spark, root, number)
        used_parts |= {(table, s, b, gen) for (table, s, b), gen in version.parts.items()}
        used_segments |= set(version.segments)
    dropped = 0
    for path in list_paths(spark, f"{root}/*/shard_id=*/*/gen=*"):
        table, shard, bucket, gen = re.search(r"/([^/]+)/shard_id=(-?\d+)/[^/=]+=(\d+)/gen=([^/]+)$", path).groups()
        if (table, int(shard), int(bucket), gen) not in used_parts:
            remove_folder(spark, path)
            dropped += 1
    for path in list_paths(spark, f"{root}/segments/*"):
        if path.rsplit("/", 1)[1] not in used_segments:
            remove_folder(spark, path)
            dropped += 1
    for number in old:
        remove_folder(spark, _folder(root, number))
    return dropped
