"""SimHash fingerprints and near-duplicates by a self-join of binary tries.

Fingerprints are 64 bits over word shingles. Texts with at most `max_bits`
differing bits are linked, and linked texts form components.

The bits are cut into max_bits + 1 blocks; two linked fingerprints agree on one
of them at least. So there is a trie for each block, with that block on top and
no error allowed in it: the self-join below one block value needs only the
fingerprints that have it, which is how the work is dealt out. Below, node
pairs go down together: their children pair up, a pair of unlike children
spends one bit, and pairs beyond the budget are dropped with all below them.
Tries are sorted arrays, nodes are ranges in them, and many node pairs are
handled at a time, depth first in bounded lots.

A block value that more than `most` fingerprints share is cut into chunks, and
each pair of chunks is a task of its own, so that no task holds an unbounded
group. Tasks return the links of a spanning forest of what they found, never
all pairs of a group; exact copies are one fingerprint from the start.

Defined cases: null and wordless texts have fingerprint zero and are linked
like any other. Repeated rows each get a row. An id that is null takes part in
linking, but is never a component's name unless the component has no other id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lexiquarry.llm.components import components
from lexiquarry.llm.rows import lookup_side, per_text, settle

SHINGLE = 4
MAX_BITS = 4
MOST = 4096
LOT = 1 << 20  # node pairs handled at a time
Near = Callable[[np.ndarray, np.ndarray], None]
LEAF = 1 << 17  # node pairs of at most so many element pairs are compared directly
SETS_APART = 128  # numbers of blocks between two sets of fingerprints
WIDE = 1 << 10  # those of more are compared one by one, the smaller many at a time

# For each byte, its bits as eight counters of one byte each, the lowest bit first.
_SPREAD = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)


def fingerprint_of(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Majority bits of the hashes of each text; a text without any has zero."""
    out = np.zeros(texts, np.uint64)
    if not len(hashes):
        return out
    edge = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    size = np.diff(np.append(edge, len(owner)))
    # Runs of at most 255 hashes, so that a counter of one byte holds them.
    nth = np.arange(len(owner)) - np.repeat(edge, size)
    run = np.flatnonzero(nth % 255 == 0)
    first = np.flatnonzero(nth[run] == 0)
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    fingerprint = np.zeros(len(edge), np.uint64)
    for k in range(8):
        part = np.add.reduceat(_SPREAD[lanes[:, k]], run).astype("<u8").view(np.uint8).reshape(-1, 8)
        count = np.add.reduceat(part.astype(np.int64), first, axis=0)
        bits = (2 * count > size[:, None]).astype(np.uint64)
        for bit in range(8):
            fingerprint |= bits[:, bit] << np.uint64(8 * k + bit)
    out[owner[edge]] = fingerprint
    return out


def simhashes(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (default all) and `simhash`, a signed long: majority bits of the XXH64 (seed 42) of word shingles."""

    def make():
        import xxhash

        digest = xxhash.xxh64_intdigest

        def of(texts: pa.Array) -> list[pa.Array]:
            hashes, sizes = [], []
            for text in texts.to_pylist():
                # Fixed rules: A-Z lower-cased; words are cut at space and the five ASCII line and tab characters.
                words = text.encode().lower().split() if text else []
                joined = b" ".join(words)
                ends = np.cumsum([len(w) + 1 for w in words]) - 1
                starts = np.concatenate(([0], ends[:-1] + 1)).astype(int).tolist()
                n = len(words)
                if n >= shingle:
                    found = [
                        digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=False)
                    ]
                else:
                    found = [digest(joined, 42)] if n else []
                hashes += found
                sizes.append(len(found))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            return [pa.array(fingerprint_of(np.array(hashes, np.uint64), owner, len(sizes)).view(np.int64))]

        return of

    return per_text(docs, make, "simhash long", text, keep, 2 << 20)


def blocks_of(max_bits: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of max_bits + 1 nearly equal blocks."""
    cut = [round(64 * k / (max_bits + 1)) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(cut[:-1], cut[1:], strict=True)]


class Forest:
    """Union-find over places of an array, for many links at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def roots(self, at: np.ndarray) -> np.ndarray:
        root = self.parent[at]
        while True:
            up = self.parent[root]
            if (up == root).all():
                self.parent[at] = root
                return root
            root = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            # One link for each root: the others come again in the next turn.
            high, first = np.unique(high, return_index=True)
            self.parent[high] = low[first]
            self.links.append((a[first], b[first]))


def trie_join(group: np.ndarray, bits: np.ndarray, depth: int, max_bits: int, near: Near) -> None:
    """Gives `near` all pairs of places of one group that differ in at most max_bits, in bounded lots.

    (group, bits) is sorted; within a group the first `depth` bits agree.
    """
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
    end = np.append(edge[1:], len(group))
    many = end - edge > 1
    start = np.stack([edge[many], end[many], edge[many], end[many], np.zeros(many.sum(), np.int64)])
    stack = [(depth, start)]
    while stack:
        depth, pairs = stack.pop()
        if pairs.shape[1] > LOT:
            half = pairs.shape[1] // 2
            stack += [(depth, pairs[:, half:]), (depth, pairs[:, :half])]
            continue
        size = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
        leaf = (size <= LEAF) | (depth == 64)
        _compare(bits, pairs[:, leaf], max_bits, near)
        pairs = pairs[:, ~leaf]
        if not pairs.shape[1]:
            continue
        a0, a1, b0, b1, spent = pairs
        am, bm = _middle(bits, a0, a1, depth), _middle(bits, b0, b1, depth)
        itself = a0 == b0
        below = [
            np.stack([a0, am, b0, bm, spent]),
            np.stack([am, a1, bm, b1, spent]),
            np.stack([a0, am, bm, b1, spent + 1]),
            np.stack([am, a1, b0, bm, spent + 1])[:, ~itself],
        ]
        below = np.concatenate(below, axis=1)
        alive = (below[0] < below[1]) & (below[2] < below[3]) & (below[4] <= max_bits)
        alive &= (below[0] != below[2]) | (below[1] - below[0] > 1)  # a node of one with itself
        below = below[:, alive]
        if below.shape[1]:
            stack.append((depth + 1, below))


def _middle(bits: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit at this depth begins to be set in each sorted range."""
    bit = np.uint64(1) << np.uint64(63 - depth)
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) >> 1
        one = (bits[mid] & bit) != 0
        high[open_[one]] = mid[one]
        low[open_[~one]] = mid[~one] + 1


def _compare(bits: np.ndarray, pairs: np.ndarray, max_bits: int, near: Near) -> None:
    """The element pairs of node pairs, a bounded lot at a time."""
    wide = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2]) >= WIDE
    for x0, x1, y0, y1 in pairs[:4, wide].T.tolist():
        step = max(1, LOT // (y1 - y0))
        for low in range(x0, x1, step):
            like = np.bitwise_count(bits[low : min(low + step, x1), None] ^ bits[None, y0:y1]) <= max_bits
            if np.count_nonzero(like) > (len(like) if x0 == y0 else 0):
                a, b = np.nonzero(like)
                a, b = a + low, b + y0
                near(a[a != b], b[a != b])
    a0, a1, b0, b1, _ = pairs[:, ~wide]
    if not len(a0):
        return
    # A node pair of more than a lot is taken some rows at a time.
    rows = np.maximum(LOT // np.maximum(b1 - b0, 1), 1)
    cuts = -((a0 - a1) // rows)
    which = np.repeat(np.arange(len(cuts)), cuts)
    a0 = a0[which] + (np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * rows[which]
    a1, b0, b1 = np.minimum(a0 + rows[which], a1[which]), b0[which], b1[which]
    many = (a1 - a0) * (b1 - b0)
    lots = np.flatnonzero(np.diff(np.cumsum(many) // LOT, prepend=-1))
    for low, high in zip(lots, np.append(lots[1:], len(many)), strict=True):
        own, wide = many[low:high], (b1 - b0)[low:high]
        which = np.repeat(np.arange(len(own)), own)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(own) - own, own)
        a = a0[low:high][which] + nth // wide[which]
        b = b0[low:high][which] + nth % wide[which]
        like = (a != b) & (np.bitwise_count(bits[a] ^ bits[b]) <= max_bits)
        if like.any():
            near(a[like], b[like])


def deal(rows: DataFrame, max_bits: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """Each row once for each trie it is in, dealt out so that a task has whole groups (trie, part).

    Rows have `simhash` and what else the join needs. Of a block value that
    more than `most` rows share, every two rows meet in one of its parts.
    """
    which = F.col("which") if "which" in rows.columns else None
    tries = [trie_of(k, first, width, which) for k, (first, width) in enumerate(blocks_of(max_bits))]
    keyed = rows.withColumn("trie", F.explode(F.array(*tries)))
    return deal_groups(keyed, most)


def trie_of(k: int, first: int, width: int, which: Column | None = None) -> Column:
    """The number of block k (of the set `which` of fingerprints, if there are several) and its value.

    The one block of 64 bits counts by its hash, and is compared whole below.
    """
    number = F.lit(k).cast("long") if which is None else which.cast("long") * SETS_APART + k
    value = F.shiftrightunsigned("simhash", 64 - first - width)
    if width > 40:
        return number * (1 << 40) + F.pmod(F.xxhash64("simhash"), F.lit(1 << 40))
    return number * (1 << 40) + value.bitwiseAND(F.lit((1 << width) - 1))


def deal_groups(keyed: DataFrame, most: int = MOST) -> DataFrame:
    # Of at most (blocks x 2^13) values few are large; they are stored, so that the rows need not be shuffled to meet them.
    large = keyed.groupBy("trie").count().where(F.col("count") > most)
    chunks = lookup_side(large.select("trie", F.ceil(2 * F.col("count") / most).alias("chunks")))
    own = F.pmod(F.xxhash64("simhash", F.lit(7)), F.col("chunks"))
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda x: F.least(x, F.col("own")) * F.col("chunks") + F.greatest(x, F.col("own")),
    )
    one = F.array(F.lit(0).cast("long"))
    cut = keyed.join(chunks, "trie", "left").withColumn("own", own)
    cut = cut.withColumn("part", F.explode(F.when(F.col("chunks").isNull(), one).otherwise(pair)))
    return cut.drop("chunks", "own").repartition("trie", "part")


def joined_tries(trie: np.ndarray, part: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[tuple]:
    """For each block of each set of fingerprints: places of the rows that have it, and the sorted arguments of `trie_join`."""
    cuts = blocks_of(max_bits)
    for number in np.unique(trie >> 40).tolist():
        first, width = cuts[number % SETS_APART]
        own = np.flatnonzero(trie >> 40 == number)
        if len(own):
            value = fp[own]
            # The block comes on top; the rest follows in a circle.
            turned = value if not first else (value << np.uint64(first)) | (value >> np.uint64(64 - first))
            # One part a block value: the places in order are in order of their values, too.
            order = np.lexsort((turned, part[own], trie[own])) if part[own].any() else np.argsort(turned)
            own, turned = own[order], turned[order]
            new = (trie[own][1:] != trie[own][:-1]) | (part[own][1:] != part[own][:-1])
            yield own, np.concatenate(([0], np.cumsum(new))), turned, width


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, most: int = MOST) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column `simhash`) that connect all within max_bits.

    Spanning links only: every two within max_bits are connected by some.
    """

    def join(batches):
        got = [[b.column(c).to_numpy() for c in ("trie", "part", "simhash")] for b in batches]
        if got:
            trie, part, fp = (np.concatenate(x) for x in zip(*got, strict=True))
            fp = fp.view(np.uint64)
            for own, group, turned, width in joined_tries(trie, part, fp, max_bits):
                forest = Forest(len(own))
                trie_join(group, turned, width, max_bits, forest.link)
                for a, b in forest.links:
                    a, b = fp[own[a]].view(np.int64), fp[own[b]].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = deal(fingerprints.select("simhash"), max_bits, most).select("trie", "part", "simhash")
    return dealt.mapInArrow(join, "a long, b long")


def linked_fingerprints(rows: DataFrame, max_bits: int, most: int) -> DataFrame:
    """(simhash, root): for each fingerprint of the rows that is linked to another, the one its component is named after."""
    distinct = settle(rows.select("simhash").distinct(), "fingerprints")
    found = settle(links(distinct, max_bits, most), "links")
    return settle(components(found).withColumnRenamed("node", "simhash"), "stars")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    most: int = MOST,
) -> DataFrame:
    """For each row: key, simhash, and component_id, the smallest key its fingerprint is linked to by any chain."""
    rows = simhashes(docs, shingle, text, [key])
    rows = settle(rows.select(F.col(f"`{key}`").alias("key"), "simhash"), "simhash")
    distinct = settle(rows.groupBy("simhash").agg(F.min("key").alias("first")), "first")
    stars = linked_fingerprints(distinct, max_bits, most)
    names = stars.join(distinct, "simhash").groupBy("root").agg(F.min("first").alias("name"))
    named = settle(stars.join(settle(names, "names"), "root").select("simhash", "name"), "named")
    known = settle(
        distinct.join(named, "simhash", "left").select("simhash", F.coalesce("name", "first").alias("component_id")),
        "classes",
    )
    return rows.join(known, "simhash").select(F.col("key").alias(key), "simhash", "component_id")


def deduplicate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    most: int = MOST,
) -> DataFrame:
    """The rows of docs of which each component keeps one: the first by key, those without key last, then by a hash of the text.

    A row is known by its key and that hash, so rows that only share a key are
    judged each by its own text. Of rows equal in both, one stays: the first by
    a hash of the other columns.
    """
    columns = docs.columns
    body = F.xxhash64(F.col(f"`{text}`").cast("string"))
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), body.alias("body"))
    rows = settle(simhashes(plain, shingle, "text", ["key", "body"]), "simhash")
    place = F.struct(F.col("key").isNull().alias("last"), "key", "body")
    stars = linked_fingerprints(rows, max_bits, most)
    rows = rows.join(stars, "simhash", "left").withColumn("root", F.coalesce("root", "simhash"))
    rows = settle(rows.select("root", place.alias("place")), "placed")
    # One row for each component; the number of its rows is counted before they are shuffled.
    groups = rows.groupBy("root").agg(F.min("place").alias("first"), F.count("*").alias("many")).where("many > 1")
    judged = rows.join(settle(groups, "groups"), "root")
    judged = settle(judged.groupBy("place").agg((F.first("first") != F.col("place")).alias("goes"), F.count("*").alias("n")), "judged")
    judged = settle(
        judged.where("goes OR n > 1").select(F.col("place.key").alias("__key"), F.col("place.body").alias("__body"), F.col("goes").alias("__goes")),
        "marked",
    )
    own = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), body.alias("__own"))
    at = f"c{columns.index(key)}"
    marked = own.join(judged, own[at].eqNullSafe(judged["__key"]) & (own["__own"] == judged["__body"]), "left")
    marked = marked.where("__goes IS NULL OR NOT __goes")
    # Repeats of a row that stays: the first goes on.
    plain_type = ("map", "variant")
    rest = [f"c{i}" for i, f in enumerate(docs.schema.fields) if not any(t in f.dataType.simpleString() for t in plain_type)]
    first = F.row_number().over(W.partitionBy(at, "__own").orderBy(F.xxhash64(*rest)))
    once = marked.where("__goes IS NULL").drop("__goes", "__key", "__body", "__own")
    again = marked.where("NOT __goes").withColumn("__n", first).where("__n = 1").drop("__goes", "__key", "__body", "__own", "__n")
    return once.unionByName(again).toDF(*columns)
