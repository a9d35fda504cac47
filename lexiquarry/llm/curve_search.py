"""Nearest neighbours by inner product, found on several shifted Hilbert curves.

Vectors are projected onto a few random directions, shifted, and ordered along
a Hilbert curve; Spark range-partitions them by their place on it. A query has
its own place, and is compared with all vectors of the blocks around it. The
next ordering, with other directions and another shift, is asked with a window
four times as wide; the lists of all orderings are merged and ranked by the
exact inner product. A query whose list another ordering and wider window has
left full and as it is asks no more. The others go on until their window is the whole
curve, so nothing is capped: vectors that lie in groups take two or three
narrow windows, and vectors without any structure, where no index can tell near
from far, end with a list that is exact.

For vectors of unlike lengths, each gets one more component that makes all of
them equally long, and queries get zero there: then the nearest by distance, to
which the curves keep, are those of largest inner product.

Equal vectors are one class from the start, with the few smallest ids that a
list can show; equal queries are asked once. Blocks have a fixed number of
rows, so a place on the curve that very many share makes more blocks, and a
task compares a bounded span of blocks with a bounded number of queries.

Defined cases: vectors null, zero or holding null or non-finite components take
no part, nor do rows without id and vectors of another size than the most
frequent one (ties: the larger). Repeated rows are rows: each that is a query
has a list of its own, and finds the others.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from lexiquarry.llm.hilbert import hilbert_keys
from lexiquarry.llm.rows import discard, lookup_side, settle

AXES = 8  # directions of a curve
BITS = 7  # of each coordinate on it
BLOCK = 1024  # rows of a block
WIDER = 4  # how much a window grows from one ordering to the next
SPAN = 16  # blocks of a task, at most
CHUNK = 4096  # queries of a task, about
LOT = 1 << 22  # products held at a time

Q, C = ["q1", "q2"], ["c1", "c2"]


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of equal size as rows, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), len(values) // max(len(column), 1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last, so that they don't depend on the batch."""
    return np.cumsum(a * b, axis=1)[:, -1] if a.shape[1] else np.zeros(len(a))


def curve(ordering: int, size: int, longest: float, seed: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """The function from vectors, and whether each is a query, to their places on one of the curves."""
    rng = np.random.default_rng([seed, ordering])
    axes = min(AXES, size + 1)
    directions = np.linalg.qr(rng.normal(size=(size + 1, axes)))[0]
    shift = rng.random(axes)
    # Coordinates of evenly spread vectors have this deviation; eight of them fit in, shifted by up to eight more.
    scale = longest / math.sqrt(size)

    def places(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
        length = np.sqrt((vectors * vectors).sum(axis=1))
        stretch = np.where(query, longest / length, 1.0)
        lift = np.where(query, 0.0, np.sqrt(np.maximum(longest**2 - length**2, 0.0)))
        at = (vectors * stretch[:, None]) @ directions[:-1] + lift[:, None] * directions[-1]
        cells = (at / scale + 4 + 8 * shift) / 16 * (1 << BITS)
        return hilbert_keys(np.clip(np.nan_to_num(cells), 0, (1 << BITS) - 1).astype(np.int64), BITS)

    return places


def usable(vector: Column) -> Column:
    """Whether a vector can take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def best_of(rows: pa.Table, queries: pa.Table, most: int) -> pa.Table:
    """The `most` best rows for each query: (q1, q2, c1, c2, score, ids); ties go to the smaller first id."""
    x, asked = matrix(rows["vector"]), matrix(queries["asked"])
    first = pc.list_element(rows["ids"], 0).to_numpy()
    near, far, scores = [], [], []
    lot = max(1, LOT // max(len(x), 1))
    for low in range(0, len(asked) if len(x) else 0, lot):  # nothing, if nothing was asked or there are no rows
        some = asked[low : low + lot]
        close = some @ x.T
        if len(x) > most:
            # All that rounding could have put in another order are looked at exactly.
            worst = np.partition(close, len(x) - most, axis=1)[:, len(x) - most]
            slack = 1e-12 * np.sqrt((some * some).sum(axis=1) * (x * x).sum(axis=1).max())
            mine, theirs = np.nonzero(close >= (worst - slack)[:, None])
        else:
            mine, theirs = (a.ravel() for a in np.indices(close.shape))
        exact = np.concatenate(
            [products(some[mine[k : k + LOT // 64]], x[theirs[k : k + LOT // 64]]) for k in range(0, len(mine), LOT // 64)]
        )
        order = np.lexsort((first[theirs], -exact, mine))
        mine, theirs, exact = mine[order], theirs[order], exact[order]
        starts = np.searchsorted(mine, mine)
        top = np.arange(len(mine)) - starts < most
        near.append(mine[top] + low)
        far.append(theirs[top])
        scores.append(exact[top])
    near, far, scores = (np.concatenate(a) if a else np.zeros(0, t) for a, t in ((near, int), (far, int), (scores, float)))
    own, other = queries.select(Q).take(near), rows.select(["h1", "h2", "ids"]).take(far)
    return pa.table(
        [own["q1"], own["q2"], other["h1"], other["h2"], pa.array(scores), other["ids"]], names=[*Q, *C, "score", "ids"]
    )


def _placed(points: DataFrame, places: Callable[[np.ndarray, np.ndarray], np.ndarray], block: int) -> tuple[DataFrame, int]:
    """The points with the number of their block along the curve, stored, and the number of blocks."""

    def keyed(batches):
        for batch in (b for b in batches if b.num_rows):
            key = places(matrix(batch.column("vector")), batch.column("query").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key, pa.int64())], [*batch.schema.names, "place"])

    schema = T.StructType([*points.schema.fields, T.StructField("place", T.LongType())])
    order = ["place", "h1", "h2"]
    ranged = points.mapInArrow(keyed, schema).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = settle(ranged.drop("place").withColumn("at", F.monotonically_increasing_id()), "curve")
    part, within = F.shiftright("at", 33), F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / block)
    # One row for each partition.
    blocks = ranged.groupBy(part.alias("part")).agg((F.max(within) + 1).alias("blocks"))
    before = F.coalesce(F.sum("blocks").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = lookup_side(blocks.select("part", "blocks", before.alias("start")))
    total = starts.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    found = ranged.withColumn("part", part).join(starts.drop("blocks"), "part")
    return found.withColumn("block", F.col("start") + within).drop("at", "part", "start"), total


def _asked(placed: DataFrame, total: int, reach: int, most: int) -> DataFrame:
    """The best `most` rows that the queries meet within `reach` blocks to both sides."""
    span = min(SPAN, reach)
    last = (total - 1) // span
    asks = placed.where("query").withColumn(
        "span",
        F.explode(
            F.sequence(
                F.greatest(F.floor((F.col("block") - reach) / span), F.lit(0)).cast("long"),
                F.least(F.floor((F.col("block") + reach) / span), F.lit(last)).cast("long"),
            )
        ),
    )
    crowd = asks.groupBy("span").count().agg(F.max("count")).first()[0] or 1
    chunks = -(-crowd // CHUNK)
    asks = asks.select(
        F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("vector").alias("asked"), F.col("span").alias("span"),
        F.pmod(F.xxhash64("h1", F.lit(3)), F.lit(chunks)).alias("chunk"),
    )
    rows = placed.where("NOT query").select(
        "h1", "h2", "vector", "ids", F.floor(F.col("block") / span).cast("long").alias("span"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return best_of(left, right, most)

    schema = "q1 long, q2 long, c1 long, c2 long, score double, ids array<long>"
    return rows.groupBy("span", "chunk").cogroup(asks.groupBy("span", "chunk")).applyInArrow(meet, schema)


def search(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of all other rows to each row that is a query.

    `is_query` is a condition on the columns of `vectors`; the key is an integer.
    """
    of = F.col(f"`{vector}`")
    hashes = [F.xxhash64(of).alias("h1"), F.xxhash64(F.lit(1), of).alias("h2")]
    found = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), of.alias("vector"), *hashes,
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    found = found.where(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = found.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 1
    found = found.where(F.size("vector") == size)

    # Classes of equal vectors with the smallest ids, one more than a list shows; queries by class.
    first = F.row_number().over(W.partitionBy("h1", "h2").orderBy("id"))
    few = found.drop("query").withColumn("n", first).where(F.col("n") <= k + 1)
    classes = few.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids"))
    classes = settle(classes, "classes")
    members = settle(found.where("query").groupBy("id", "h1", "h2").agg(F.count("*").alias("times")), "members")
    active = found.where("query").groupBy("h1", "h2").agg(F.first("vector").alias("vector"))
    active = settle(active, "queries")
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest = math.sqrt(classes.agg(F.max(norm)).first()[0] or 1.0)

    best, ordering, reach = None, 0, 1
    while True:
        points = classes.withColumn("query", F.lit(False)).unionByName(
            active.select("h1", "h2", "vector", F.array().cast("array<long>").alias("ids"), F.lit(True).alias("query"))
        )
        placed, total = _placed(points, curve(ordering, size, longest, seed), block)
        met = _asked(placed, total, reach, k + 1).withColumn("old", F.lit(0))
        if best is not None:
            met = met.unionByName(best)
        by = [F.desc("score"), F.get("ids", F.lit(0)), *C]
        top = met.withColumn("r", F.dense_rank().over(W.partitionBy(*Q).orderBy(*by))).where(F.col("r") <= k + 1)
        merged = top.groupBy(*Q, *C).agg(F.first("score").alias("score"), F.first("ids").alias("ids"), F.max("old").alias("old"))
        merged = settle(merged, "best")
        discard(placed, *([best] if best is not None else []))
        best = merged.withColumn("old", F.lit(1))
        if reach >= total:
            break
        # A list that is full and has nothing new stays as it is.
        done = merged.groupBy(F.col("q1").alias("h1"), F.col("q2").alias("h2")).agg(F.min("old").alias("old"), F.count("*").alias("n"))
        done = done.where((F.col("old") == 1) & (F.col("n") > k))
        still = settle(active.join(done, ["h1", "h2"], "left_anti"), "queries")
        discard(active)
        active = still
        if active.isEmpty():
            break
        ordering, reach = ordering + 1, reach * WIDER

    # Lists of classes become lists of rows, for each query row without itself.
    lists = members.withColumnsRenamed({"id": "query_id", "h1": "q1", "h2": "q2"}).join(best.drop("old"), Q)
    own = F.when((F.col("q1") == F.col("c1")) & (F.col("q2") == F.col("c2")), F.array_position("ids", F.col("query_id")))
    others = F.filter("ids", lambda x, i: (i + 1 != F.coalesce(own, F.lit(0))))
    rows = lists.select("query_id", *Q, "times", "score", F.explode(others).alias("vec_id"))
    rank = F.row_number().over(W.partitionBy("query_id", *Q).orderBy(F.desc("score"), "vec_id"))
    rows = rows.withColumn("rank", rank).where(F.col("rank") <= k)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return rows.withColumn("again", again).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
