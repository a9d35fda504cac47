"""A Merkle manifest of a table, and proofs that climb it.

Every row has a leaf, the hash of its values. Leaves are numbered within their
group by key; every `FAN` consecutive nodes of a level become one run, whose
hash is that of their digests one after another, until one node is left: the
group's subroot. Subroots, in the order of the groups, are built up likewise to
the root. Hashes are sha256 as lower-case hex text.

Levels are built one after another and stored as rows of runs, each with the
digests of its members and a link to the run above. `climb` proves rows against
them by a recursive query: a row of it stands for the leaves of one lowest run,
which share all siblings above; a step joins it with the run above, appends the
other members' digests to the proof and folds what each leaf claims to be with
them, until there is no run above.

No task holds a group: leaves are numbered after a range-partitioned sort, by
their place in the partition and the counts of the partitions before. Runs have
at most FAN members. High runs are met by very many climbers, so each is given
as many copies as it has thousands of climbers below, and climbers are dealt
out to the copies.

Defined cases: a null value hashes as `-`; a null group is a group, the first;
null keys come first, equal keys in the order of their leaves, so that repeated
rows are leaves of their own. An empty table has no root and no rows. Input
columns other than those named do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lexiquarry.llm.rows import lookup_side, settle

FAN = 16
DIGEST = 64  # characters of a digest
TOP = -1  # the tree of the subroots
CROWD = 1024  # climbers that meet one copy of a run, about

_ROWS = "spark.sql.cteRecursionRowLimit"


def leaf_hash(columns: list[str], **instead: Column) -> Column:
    """Hash of the columns' values, each as its UTF-8 length, a colon and itself, or `-` if null."""
    values = [instead.get(c, F.col(f"`{c}`")).cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*fields), 256)


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """rows and `ord`, the number of each row within its group (no nulls in its columns) in this order.

    The rows are sorted over all partitions. Of each partition and group only
    the count is looked at to know where the next one goes on.
    """
    keys = [*group, *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = settle(ranged.withColumn("at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    many = ranged.groupBy(*group, "part").agg(F.min("at").alias("low"), F.count("*").alias("many"))
    before = W.partitionBy(*group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("many").over(before), F.lit(0)) - F.col("low")
    starts = lookup_side(many.select(*group, "part", shift.alias("shift")))
    found = ranged.join(starts, [*group, "part"]).withColumn("ord", F.col("at") + F.col("shift"))
    return found.drop("at", "part", "shift")


@dataclass(frozen=True)
class Manifest:
    """What is stored of a table.

    members(tree, run, members(key, leaf, told)): the leaves by lowest run;
    runs(tree, level, ord, children, hash, up_tree, up_level, up_ord, pos, copies, up_copies): the built levels,
    `children` being the members' digests one after another;
    trees(tree, name, size, subroot): the groups in order; root: the digest of all, None of an empty table.
    """

    members: DataFrame
    runs: DataFrame
    trees: DataFrame
    root: str | None


def _above(size: Column, tree: Column, level: Column, ord_: Column, trees: int) -> list[Column]:
    """Where the run above a node is, and the node's place in it; null at the root."""
    inner = size > 1
    outer = (tree != TOP) & F.lit(trees > 1)
    pick = lambda a, b: F.when(inner, a).when(outer, b)
    return [
        pick(tree, F.lit(TOP).cast("long")).alias("up_tree"),
        pick(level + 1, F.lit(1)).alias("up_level"),
        pick(F.floor(ord_ / FAN), F.floor(tree / FAN)).cast("long").alias("up_ord"),
        pick(ord_ % FAN, tree % FAN).cast("int").alias("pos"),
    ]


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Stored runs (tree, level, ord, children, hash, size, weight) above nodes (tree, ord, hash, size, weight).

    size: how many nodes the tree has on that level; weight: how many lowest runs are below.
    """
    built = []
    while most > 1:
        grouped = (
            nodes.where("size > 1")
            .groupBy("tree", F.floor(F.col("ord") / FAN).cast("long").alias("ord"), "size")
            .agg(F.array_sort(F.collect_list(F.struct("ord", "hash"))).alias("m"), F.sum("weight").alias("weight"))
        )
        joined = grouped.withColumn("children", F.array_join("m.hash", ""))
        nodes = settle(
            joined.select(
                "tree",
                F.lit(len(built) + 1).alias("level"),
                "ord",
                "children",
                F.sha2("children", 256).alias("hash"),
                F.ceil(F.col("size") / FAN).cast("long").alias("size"),
                "weight",
            ),
            "level",
        )
        built.append(nodes)
        most = -(-most // FAN)
    return built


def build(leaves: DataFrame, key: str, group: str, leaf: str = "leaf", told: str | None = None) -> Manifest:
    """The manifest of rows with a leaf hash; `told` is what a leaf claims to be when it climbs (default: itself)."""
    told = told or leaf
    slim = leaves.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{group}`").alias("name"),
        F.col(f"`{leaf}`").alias("leaf"),
        F.col(f"`{told}`").alias("told"),
    )
    slim = settle(slim, "leaves")
    sizes = slim.groupBy("name").agg(F.count("*").alias("size"))
    trees = lookup_side(numbered(sizes, [], ["name"]).withColumnRenamed("ord", "tree"))
    count, most = trees.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    of = trees.select(F.col("name").alias("of"), "tree", "size")
    placed = numbered(slim.join(of, F.col("name").eqNullSafe(F.col("of"))).drop("name", "of"), ["tree"], ["key", "leaf"])

    # The lowest runs carry their leaves; a group of one leaf is a run that is not hashed.
    members = settle(
        placed.groupBy("tree", "size", F.floor(F.col("ord") / FAN).cast("long").alias("run"))
        .agg(F.array_sort(F.collect_list(F.struct("ord", "key", "leaf", "told"))).alias("members"))
        .withColumn("children", F.array_join("members.leaf", "")),
        "members",
    )
    lowest = members.select(
        "tree",
        F.col("run").alias("ord"),
        F.when(F.col("size") > 1, F.sha2("children", 256)).otherwise(F.col("children")).alias("hash"),
        F.ceil(F.col("size") / FAN).cast("long").alias("size"),
        F.lit(1).cast("long").alias("weight"),
        "children",
        F.when(F.col("size") > 1, 1).otherwise(0).alias("level"),
    )
    inner = _levels(lowest, -(-most // FAN))
    columns = ["tree", "level", "ord", "children", "hash", "size", "weight"]
    all_runs = lowest.select(columns)
    for k in inner:
        all_runs = all_runs.unionByName(k.withColumn("level", F.col("level") + 1))
    subroots = settle(all_runs.where("size = 1").select("tree", "hash", "weight"), "subroots")
    top = _levels(
        subroots.select(
            F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("ord"), "hash", F.lit(count).alias("size"), "weight"
        ),
        count,
    )
    for k in top:
        all_runs = all_runs.unionByName(k)
    linked = all_runs.select(
        *columns, *_above(F.col("size"), F.col("tree"), F.col("level"), F.col("ord"), count)
    ).withColumn("copies", F.ceil(F.col("weight") / CROWD).cast("long"))
    crowded = linked.where("copies > 1")
    crowded = crowded.select(
        F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("ord").alias("up_ord"),
        F.col("copies").alias("up_copies"),
    )
    runs = linked.join(lookup_side(crowded), ["up_tree", "up_level", "up_ord"], "left")
    runs = settle(runs.withColumn("up_copies", F.coalesce("up_copies", F.lit(1).cast("long"))).drop("size", "weight"), "runs")
    root = runs.where("up_tree is null").select("hash").first()
    named = trees.join(subroots.select("tree", F.col("hash").alias("subroot")), "tree")
    return Manifest(members, runs, named, root and root["hash"])


# 64: DIGEST.
_CLIMB = """
WITH RECURSIVE climb(tree, run, up_tree, up_level, up_ord, pos, up_copies, above, folded) AS (
    SELECT tree, run, up_tree, up_level, up_ord, pos, up_copies, '', folded FROM {lowest}
    UNION ALL
    SELECT c.tree, c.run, n.up_tree, n.up_level, n.up_ord, n.pos, n.up_copies,
        concat(c.above, substring(n.children, 1, 64 * c.pos), substring(n.children, 64 * c.pos + 64 + 1)),
        transform(c.folded, f -> sha2(concat(
            substring(n.children, 1, 64 * c.pos), f, substring(n.children, 64 * c.pos + 64 + 1)), 256))
    FROM climb c JOIN {nodes} n
        ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_ord = n.ord
        AND pmod(xxhash64(c.tree, c.run), c.up_copies) = n.copy
)
SELECT tree, run, above, folded FROM climb WHERE up_tree IS NULL
"""


def climb(manifest: Manifest) -> DataFrame:
    """(key, leaf, told, tree, folded_root, proof) of every leaf.

    proof: the digests of its siblings, level by level up to the root, left to
    right; folded_root: what the leaf's claim and they make the root to be.
    """
    spark = manifest.members.sparkSession
    before = F.substring(F.col("children"), F.lit(1), DIGEST * F.col("i"))
    after = F.substring(F.col("children"), DIGEST * F.col("i") + DIGEST + 1, F.lit(FAN * DIGEST))
    first = manifest.runs.where(f"tree <> {TOP} AND level < 2").withColumnRenamed("ord", "run")
    own = f"sha2(concat(substring(children, 1, {DIGEST} * i), m.told, substring(children, {DIGEST} * i + {DIGEST} + 1)), 256)"
    lowest = manifest.members.select(
        "tree", "run", F.expr(f"transform(members, (m, i) -> CASE WHEN size > 1 THEN {own} ELSE m.told END)").alias("folded")
    ).join(first.drop("children"), ["tree", "run"])
    nodes = manifest.runs.where(f"level > 1 OR tree = {TOP}")
    nodes = nodes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    had = spark.conf.get(_ROWS, None)
    spark.conf.set(_ROWS, "-1")  # the rows of all steps; their number grows with the table
    try:
        reached = settle(spark.sql(_CLIMB, lowest=lowest, nodes=nodes), "reached")
    finally:
        if had is None:
            spark.conf.unset(_ROWS)
        else:
            spark.conf.set(_ROWS, had)
    # A run's leaves part only here: the proof above them is long, and the same for all.
    apart = manifest.members.join(reached, ["tree", "run"]).select(
        "tree", "children", "above", F.posexplode(F.arrays_zip("members", "folded")).alias("i", "z")
    )
    return apart.select(
        *(F.col(f"z.members.{c}").alias(c) for c in ("key", "leaf", "told")),
        "tree",
        F.col("z.folded").alias("folded_root"),
        F.concat(before, after, "above").alias("proof"),
    )
