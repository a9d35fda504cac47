"""Top rows per key, safe when one key holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def pushed_limit(spark: SparkSession) -> int:
    """The k up to which a filter row_number() <= k is pushed below the shuffle, so that each map task sends at most k rows per key."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; map tasks send one row per key at most."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def top_rows(
    df: DataFrame, keys: list[str], order: list[Column], k: int, salt: str, rank: str = "rank"
) -> DataFrame:
    """The first `k` rows per key with their `rank`.

    Up to `pushed_limit` Spark prunes before the shuffle by itself. Beyond, the
    rows of a key are first ranked in groups by a hash of the `salt` column, so
    that no single task sorts all rows of a hot key; the top k of the groups
    hold the top k of the key.
    """
    if k > pushed_limit(df.sparkSession):
        groups = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        local = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(groups)))
            .withColumn("_row", F.row_number().over(local))
            .where(F.col("_row") <= k)
            .drop("_salt", "_row")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_row", F.row_number().over(window)).where(F.col("_row") <= k)
    return ranked.withColumn(rank, F.col("_row").cast("bigint")).drop("_row")
