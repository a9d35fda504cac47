"""Session defaults, stored intermediate results and the shared folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str = "local[*]", app: str = "lexiquarry", folder: str | None = None, **conf
) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps.

    `folder` is where intermediate tables go, on storage all executors share.
    """
    if folder:
        conf["spark.checkpoint.dir"] = folder
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """The frame written once to the shared folder and read back.

    For results used several times over. Lost executors cost nothing that was
    written, and later plans start from a table whose size is known. Shuffles
    that led to it are freed once it is written. The folder stays until
    `release`.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(folder)
    _settled.setdefault(spark.sparkContext.applicationId, []).append(folder)
    if (passing := _passing.get()) is not None:
        passing.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what is written inside are deleted once it is written, not when the driver collects its garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What this thread settles inside is deleted at the end; for work whose results are stored elsewhere."""
    folders: list[str] = []
    token = _passing.set(folders)
    try:
        yield
    finally:
        _passing.reset(token)
        known = _settled.get(spark.sparkContext.applicationId, [])
        for folder in (f for f in folders if f in known):
            remove_folder(spark, folder)
            known.remove(folder)


def lookup_side(df: DataFrame) -> DataFrame:
    """The frame as the small side of a join: worked out once, its bytes known.

    No task sees the whole of it and nothing is hinted: Spark broadcasts the
    stored table if its files are below spark.sql.autoBroadcastJoinThreshold,
    and shuffles both sides on the key if not, where adaptive execution splits
    the partitions a hot key makes too large.
    """
    return settle(df, "side")


_settled: dict[str, list[str]] = {}
_passing: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


def release(spark: SparkSession) -> int:
    """Delete what this application has settled; no frame that reads it may be used any more."""
    folders = _settled.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        remove_folder(spark, folder)
    return len(folders)


def discard(*frames: DataFrame) -> None:
    """Delete what `settle` has stored of these frames, which nothing may read any more."""
    for df in frames:
        spark = df.sparkSession
        known = _settled.get(spark.sparkContext.applicationId, [])
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            own = [f for f in known if folder.endswith("/" + f.rsplit("/", 1)[1])]
            for f in own:
                remove_folder(spark, f)
                known.remove(f)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that match a pattern, on any storage Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(status.getPath().toString()) for status in found or [])


def spread(scan: DataFrame, *keys: str | Column) -> DataFrame:
    """Hash-partition a table scan that would use fewer tasks than there are cores.

    Text analysis is bound by CPU. A large table has a task per file split and
    is returned as is; a single small file would otherwise run on one core.
    Call it on a plain scan: a plan with shuffles has to run them to tell its
    partitions.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    # Several tasks per core even out texts of very different length.
    return scan.repartition(4 * cores, *keys)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one the cluster names in spark.checkpoint.dir.

    Only a local session that names none gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = _local_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"lexiquarry-{application}-")
