"""Benchmark decontamination: an FM-index over each shard of the corpus, asked for all test phrases.

A shard is what a task holds at a time: some megabytes of whole documents. Its
words become symbols; a word that no benchmark item has can be in no match, so
it becomes a separator, and stretches between separators that are shorter than
the shortest phrase are left out. The phrases (13 consecutive words of an item,
or the whole of a shorter one) are searched backward through the ranks of a
wavelet matrix, all at once; occurrences are located by sampled suffix
positions, and their words merged into spans.

The benchmark is the stated query set. It is sent to the tasks in blocks of at
most `block_bytes` of text; several blocks are several passes over the rows,
each adding to what the one before has found. Documents are not shuffled.

Defined cases: null or empty text has no words and no hits. Items without words
are ignored. Repeated items count once; an item without id marks words, but is
not listed. Repeated documents each get a row. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.fmindex import FMIndex
from lexiquarry.llm.rows import per_text, raw_bytes
from lexiquarry.llm.words import words_in, words_of

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
FIELDS = "n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>"


@dataclass
class Phrases:
    """Distinct phrases of some items, as word numbers from 1, aligned to the right."""

    words: pa.Array
    rows: np.ndarray
    lengths: np.ndarray
    owner_ends: np.ndarray  # items of phrase i: owners[owner_ends[i]:owner_ends[i + 1]]
    owners: np.ndarray
    ids: list[str | None]


def phrases(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Phrases:
    words = words_of(pa.array([text for _, text in items], pa.string()))
    coded = words.arrow().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    size = words.counts()
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    many = np.where(size > 0, np.maximum(size - window + 1, 1), 0)
    item = np.repeat(np.arange(len(items)), many)
    start = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    length = np.minimum(size[item], window)
    rows = np.zeros((len(item), window), np.int64)
    for back in range(1, window + 1):
        has = length >= back
        rows[has, window - back] = codes[start[has] + length[has] - back]
    distinct, which = np.unique(rows, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), item]), axis=1)
    return Phrases(
        words=coded.dictionary,
        rows=distinct,
        lengths=(distinct > 0).sum(axis=1),
        owner_ends=np.concatenate(([0], np.cumsum(np.bincount(pairs[0], minlength=len(distinct))))),
        owners=pairs[1],
        ids=[i for i, _ in items],
    )


def blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list]:
    """The items in lists of at most so many bytes of text (or one item)."""
    rows, held = [], 0
    asked = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    for i, t in asked.where("t is not null").distinct().toLocalIterator():
        size = len(t.encode())
        if rows and held + size > most:
            yield rows
            rows, held = [], 0
        rows.append((i, t))
        held += size
    if rows:
        yield rows


def hits_in(texts: pa.Array, asked: Phrases) -> tuple:
    """Words of the texts, which of them are hit, and the (text, item) pairs met."""
    raw, offsets = raw_bytes(texts)
    words = words_in(raw, offsets)
    hit = np.zeros(len(words) + 1, np.int64)
    none = words, hit[:-1] > 0, np.zeros((2, 0), np.int64)
    if not len(words) or not len(asked.rows):
        return none
    codes = pc.fill_null(pc.index_in(words.arrow(), asked.words), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    # Stretches of known words within a text.
    known = codes > 0
    joined = known[1:] & known[:-1] & (words.text[1:] == words.text[:-1])
    begin = np.flatnonzero(known & ~np.concatenate(([False], joined)))
    end = np.flatnonzero(known & ~np.append(joined, False)) + 1
    long = end - begin >= asked.lengths.min()
    begin, size = begin[long], (end - begin)[long]
    if not len(begin):
        return none
    place = np.repeat(begin - np.concatenate(([0], np.cumsum(size + 1)[:-1])), size + 1) + np.arange((size + 1).sum())
    symbols = codes[np.minimum(place, len(codes) - 1)]
    symbols[np.cumsum(size + 1) - 1] = 0
    index = FMIndex(symbols, len(asked.words) + 1)
    low, high = index.search(asked.rows, asked.lengths)
    many = high - low
    which = np.repeat(np.arange(len(many)), many)
    if not len(which):
        return none
    rows = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(which))
    at = place[index.locate(rows)]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + asked.lengths[which], -1)
    met = np.unique(words.text[at] * len(many) + which)
    text, which = met // len(many), met % len(many)
    owners = asked.owner_ends[which + 1] - asked.owner_ends[which]
    nth = np.arange(owners.sum()) - np.repeat(np.cumsum(owners) - owners, owners)
    item = asked.owners[np.repeat(asked.owner_ends[which], owners) + nth]
    return words, np.cumsum(hit)[:-1] > 0, np.unique(np.stack([np.repeat(text, owners), item]), axis=1)


def spans_of(words, hit: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of hit words as code points of their text: [first, last)."""
    joined = hit[1:] & hit[:-1] & (words.text[1:] == words.text[:-1])
    begin = np.flatnonzero(hit & ~np.concatenate(([False], joined)))
    end = np.flatnonzero(hit & ~np.append(joined, False))
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    text = words.text[begin]
    base = points[offsets[text]]
    pairs = pa.StructArray.from_arrays(
        [pa.array(points[words.first[begin]] - base), pa.array(points[words.last[end]] - base)], ["first", "last"]
    )
    return lists(text, pairs, words.texts)


def lists(owner: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """Values of ascending owners as one list for each owner."""
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Kept columns (default all), n_words, n_hit, the ids of items met (sorted) and the spans to remove, in code points."""
    spark = docs.sparkSession
    keep = list(docs.columns if keep is None else keep)
    found = None
    passed = [*dict.fromkeys([*keep, text])]
    for block in blocks(benchmark, item, item_text, block_bytes) if benchmark.columns else ():
        asked = spark.sparkContext.broadcast(phrases(block, window))
        if found is None:
            found = per_text(docs, lambda asked=asked: finder(asked.value), FIELDS, text, passed, shard_bytes)
        else:
            found = merged(found, asked, text, passed, shard_bytes)
    if found is None:
        found = per_text(docs, lambda: finder(phrases([], window)), FIELDS, text, passed, shard_bytes)
    new = ["n_words", "n_hit", "items", "spans"]
    return found.select(*(F.col(f"`{c}`") for c in keep if c not in new), *new)


def finder(asked: Phrases):
    def of(texts: pa.Array) -> list[pa.Array]:
        raw, offsets = raw_bytes(texts)
        words, hit, met = hits_in(texts, asked)
        named = sorted((int(t), asked.ids[i]) for t, i in met.T if asked.ids[i] is not None)
        named = list(dict.fromkeys(named))
        return [
            pa.array(words.counts()),
            pa.array(np.bincount(words.text[hit], minlength=words.texts).astype(np.int64)),
            lists(np.array([t for t, _ in named], np.int64), pa.array([i for _, i in named], pa.string()), words.texts),
            spans_of(words, hit, raw, offsets),
        ]

    return of


def merged(found: DataFrame, asked, text: str, passed: list[str], shard_bytes: int) -> DataFrame:
    """A further block's hits joined to those already found, row by row."""
    old = {"n_words": "w_", "n_hit": "h_", "items": "i_", "spans": "s_"}
    held = found.select(
        *(F.col(f"`{c}`") for c in passed if c not in old), *(F.col(a).alias(f"__{b}") for a, b in old.items())
    )
    keep = held.columns
    new = per_text(held, lambda: finder(asked.value), FIELDS, text, keep, shard_bytes)
    both = new.withColumn("items", F.array_sort(F.array_union("__i_", "items")))
    # Spans of either block, as sorted and joined runs; words are counted anew from the text.
    ordered = F.array_sort(F.concat("__s_", "spans"))
    joined = F.aggregate(
        ordered,
        F.array().cast("array<struct<first:long,last:long>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["last"] >= s["first"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["first"].alias("first"),
                        F.greatest(F.get(done, F.size(done) - 1)["last"], s["last"]).alias("last"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    both = both.withColumn("spans", joined)
    hit = F.aggregate(
        F.transform(
            "spans",
            lambda s: F.size(
                F.regexp_extract_all(
                    F.substring(F.col(f"`{text}`"), s["first"].cast("int") + 1, (s["last"] - s["first"]).cast("int")),
                    F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"),
                    F.lit(0),
                )
            ).cast("long"),
        ),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    both = both.withColumn("n_hit", hit)
    return both.drop("__w_", "__h_", "__i_", "__s_")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The contract's columns: item ids joined and hashed, and the verdict by share of hit words."""
    return found.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def contaminated():
    """At least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
