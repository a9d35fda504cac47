"""Packing documents into sequences by cutting-stock column generation.

Each document becomes ids (and an end id). It is cut into pieces of the full
length and a remainder. The histogram of piece lengths, in classes of `grain`
tokens, is the order book of a cutting-stock problem: a linear program chooses
how often to use each pattern (a multiset of classes that fits a sequence), and
a knapsack by dynamic programming prices new patterns until none improves it.
The program has at most capacity / grain rows, whatever the corpus, and is
solved on the driver from that many counts. Its solution is rounded down; what
is left over is filled by greedy patterns, of which there are at most a few for
each class. Every use of a pattern is a sequence with slots; the pieces of a
class are ranked, and the rank finds the slot.

Ranks come from counts for (class, hash bucket) and a row number within, so
that a class with a third of all pieces is dealt to many tasks. Texts are not
shuffled: a row knows its pieces and their checksums when it has been tokenized.

Defined cases: null or empty text is the end id alone. Repeated rows are packed
as often as they occur. A document without id is packed like any other.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiquarry.llm.rows import per_text, settle

CAPACITY = 4096
GRAIN = 8
END_ID = 2
KEPT = 300_000  # words whose ids a Python worker remembers
BUCKET_ROWS = 50_000  # pieces of a class ranked together

WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the vocabulary's own pre-tokens


class Encoder:
    """Ids of texts by a tokenizers file whose pre-tokens never hold white space, with a memory of words.

    White space only separates there, so a text's ids are those of its words
    one after another, and each distinct word of a batch is looked up once.
    New words go to the library; plain ASCII ones to its model directly.
    """

    def __init__(self, file: str, kept: int = KEPT):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.parts = regex.compile(WORD).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.kept = kept

    def words(self, words: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        hard: list[int] = []
        young, old = self.young, self.old
        for k, word in enumerate(words):
            ids = young.get(word)
            if ids is None:
                ids = old.get(word)
                if ids is None and word.isascii() and word.isprintable() and "<|" not in word:
                    found = [t.id for part in self.parts(word.lower()) for t in self.model.tokenize(part)]
                    ids = np.array(found, "<u4").tobytes()
                if ids is None:
                    hard.append(k)
                else:
                    young[word] = ids
            out.append(ids)
        if hard:
            asked = [words[k] for k in hard]
            for k, got in zip(hard, self.tokenizer.encode_batch_fast(asked, add_special_tokens=False), strict=True):
                out[k] = young[words[k]] = np.array(got.ids, "<u4").tobytes()
        if len(young) > self.kept // 2:
            self.old, self.young = young, {}
        return out

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text begins."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # Fixed rule: these are white space for the vocabulary's pattern, too.
        for space in "\n\t\r":
            texts = pc.replace_substring(texts, space, " ")
        split = pc.split_pattern(texts, " ")
        coded = split.values.dictionary_encode()
        distinct = self.words(coded.dictionary.to_pylist())
        size = np.array([len(x) // 4 for x in distinct], np.int64)
        pool = np.frombuffer(b"".join(distinct), "<u4")
        begin = np.cumsum(size) - size
        word = coded.indices.to_numpy(zero_copy_only=False)
        many = size[word]
        ends = np.concatenate(([0], np.cumsum(many)))
        at = np.repeat(begin[word] - ends[:-1], many) + np.arange(ends[-1])
        # A slice's list offsets are relative to its child as a whole.
        offsets = split.offsets.to_numpy()
        return pool[at], ends[offsets - offsets[0]]


@functools.lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    return Encoder(file)


def token_pieces(
    docs: DataFrame, file: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """The pieces of each document: key, start, length, ids_crc32, doc_tokens."""

    def make():
        encode = encoder(file).texts

        def of(texts: pa.Array) -> list[pa.Array]:
            ids, begin = encode(texts)
            first, sizes, sums, ends = [], [], [], [0]
            total = np.diff(begin) + 1
            for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), capacity):
                    piece = own[start : start + capacity]
                    first.append(start)
                    sizes.append(len(piece))
                    sums.append(zlib.crc32(piece))
                ends.append(len(first))
            piece = pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (first, sizes, sums)], ["start", "length", "ids_crc32"]
            )
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), piece), pa.array(total, pa.int64())]

        return of

    fields = "pieces array<struct<start:long,length:long,ids_crc32:long>>, doc_tokens long"
    rows = per_text(docs, make, fields, text, [key], 6 << 20)
    return rows.select(F.col(f"`{key}`"), "doc_tokens", F.inline("pieces")).select(
        F.col(f"`{key}`"), "start", "length", "ids_crc32", "doc_tokens"
    )


def knapsack(values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The best multiset of items 1..room of their own size; values[i] is that of size i + 1."""
    best = np.zeros(room + 1)
    last = np.zeros(room + 1, np.int64)
    for size in range(1, room + 1):
        total = values[:size] + best[size - 1 :: -1] if size > 1 else values[:1] + best[:1]
        k = int(np.argmax(total))
        if total[k] > best[size - 1] + 1e-12:
            best[size], last[size] = total[k], k + 1
        else:
            best[size], last[size] = best[size - 1], 0
    pattern = np.zeros(room, np.int64)
    size = room
    while size > 0:
        if last[size]:
            pattern[last[size] - 1] += 1
            size -= last[size]
        else:
            size -= 1
    return float(best[room]), pattern


def cutting_stock(demand: np.ndarray, rounds: int = 6000, gap: float = 5e-4) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use each, so that they hold demand[i] pieces of size i + 1 in all.

    Column generation with a revised simplex; it ends when no pattern prices
    in, or when the bound shows the program within `gap` of its optimum.
    """
    room = len(demand)
    sizes = np.flatnonzero(demand) + 1
    if not len(sizes):
        return []
    need = demand[sizes - 1].astype(float)
    m = len(sizes)
    basis = np.diag(room // sizes).astype(float)  # columns are patterns over the sizes in use
    inverse = np.diag(1.0 / (room // sizes))
    x = inverse @ need
    for step in range(rounds):
        price = inverse.sum(axis=0)  # duals: every pattern costs one sequence
        values = np.zeros(room)
        values[sizes - 1] = np.maximum(price, 0)
        worth, pattern = knapsack(values, room)
        used = x.sum()
        if worth <= 1 + 1e-9 or used - (price @ need) / worth <= gap * used:
            break
        column = pattern[sizes - 1].astype(float)
        move = inverse @ column
        ratio = np.where(move > 1e-9, x / np.where(move > 1e-9, move, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        theta = ratio[out]
        x = np.maximum(x - theta * move, 0)
        x[out] = theta
        basis[:, out] = column
        pivot = inverse[out] / move[out]
        inverse -= np.outer(move, pivot)
        inverse[out] = pivot
        if step % 200 == 199:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ need, 0)
    chosen: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64).copy()
    for k in np.argsort(-x, kind="stable"):
        pattern = np.zeros(room, np.int64)
        pattern[sizes - 1] = np.rint(basis[:, k]).astype(np.int64)
        has = pattern > 0
        times = min(int(x[k] + 1e-9), int((left[has] // pattern[has]).min()))
        if times > 0:
            chosen.append((pattern, times))
            left -= times * pattern
    # The rest: largest classes first, each pattern as often as the rest allows.
    while left.any():
        pattern, free = np.zeros(room, np.int64), room
        for size in (np.flatnonzero(left) + 1)[::-1]:
            take = min(int(left[size - 1]), free // int(size))
            pattern[size - 1] = take
            free -= take * int(size)
        has = pattern > 0
        times = int((left[has] // pattern[has]).min())
        chosen.append((pattern, times))
        left -= times * pattern
    return chosen


class Slots:
    """Where the piece of a class and rank goes: tables of at most (patterns x classes) entries."""

    def __init__(self, chosen: list[tuple[np.ndarray, int]]):
        given: dict[int, int] = {}
        rows, sequence = [], 0
        for pattern, times in chosen:
            for size in (np.flatnonzero(pattern) + 1).tolist():
                many = int(pattern[size - 1])
                rows.append((size << 48 | given.get(size, 0), many, sequence))
                given[size] = given.get(size, 0) + many * times
            sequence += times
        rows.sort()
        self.key, self.many, self.sequence = (np.array(x, np.int64) for x in zip(*rows, strict=True))

    def sequences(self, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.key, size << 48 | rank, "right") - 1
        return self.sequence[at] + (rank - (self.key[at] & ((1 << 48) - 1))) // self.many[at]


def pack(
    pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, grain: int = GRAIN, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Pieces with their sequence and the offset in it; `pieces` as `token_pieces` gives them."""
    spark = pieces.sparkSession
    pieces = settle(pieces.withColumn("size", F.ceil(F.col("length") / grain).cast("long")), "pieces")
    counts = {r["size"]: r["count"] for r in pieces.groupBy("size").count().collect()}
    room = capacity // grain
    demand = np.array([counts.get(size, 0) for size in range(1, room + 1)], np.int64)
    if not demand.any():
        return pieces.drop("size").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    slots = spark.sparkContext.broadcast(Slots(cutting_stock(demand)))

    buckets = 16 + int(demand.max()) // bucket_rows
    mark = F.xxhash64(F.col(f"`{key}`"), "start", "ids_crc32")
    dealt = pieces.withColumn("mark", mark).withColumn("bucket", F.pmod("mark", F.lit(buckets)))
    sizes = dealt.groupBy("size", "bucket").count()
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("size", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("size", "bucket").orderBy("mark", F.col(f"`{key}`"), "start", "ids_crc32")
    ranked = dealt.withColumn("nth", F.row_number().over(within) - 1).join(sizes, ["size", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth"))

    columns = [c for c in pieces.columns if c != "size"]
    plain = ranked.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)), "size", "rank")
    schema = ", ".join(f"k{i} {t}" for i, (_, t) in enumerate(pieces.drop("size").dtypes)) + ", sequence_id long"

    def place(batches):
        find = slots.value.sequences
        for b in batches:
            found = find(b.column("size").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-2], pa.array(found)], [*b.schema.names[:-2], "sequence_id"]
            )

    placed = plain.mapInArrow(place, schema)
    placed = placed.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(columns)), "sequence_id")
    order = [F.desc("length"), F.col(f"`{key}`"), F.col("start"), F.col("ids_crc32")]
    ahead = Window.partitionBy("sequence_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long"))
