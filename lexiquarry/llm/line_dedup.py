"""Fuzzy line dedup: one occurrence of every group of like lines stays.

Lines are normalised to their lower-cased words. Equal ones are one line from
the start. Each has `prints` independent SimHashes of its distinct words; lines
that agree on one of the max_bits + 1 pigeonhole blocks of one of them meet, and
those within max_bits differing bits of it are candidates. (Several find more,
because one replaced word turns about 64 / n bits of a line of n words, each
SimHash by its own chance.) Candidates whose normalised texts have an edit similarity of at
least 0.8 (one less the edits by the longer length, in characters) are linked,
linked lines form groups, and of each group the first occurrence by (key, hash of
the text, line number) stays.

Texts travel late: fingerprints alone tell which lines have a candidate at all,
and only the texts of these are fetched and dealt to the blocks in which they
have one. There, candidates are verified as long as they would join two groups,
each group choosing one at a time, so a large group of like lines costs about
as many comparisons as it has lines. Large blocks are cut into pairs of chunks.
The documents themselves are joined once with the numbers of the lines to go.
Each stored step is deleted as soon as the next ones no longer read it.

Defined cases: null text stays null, empty text empty. Lines of fewer than
`min_words` words are not compared; with `short` their exact repeats go like
those of others, without it they stay. A character of a script without spaces
counts as a word there. Lines without any word stay. A document may lose all its
lines; its row stays, with empty text. A row is known by its key and a hash of
its text: rows equal in both are one document, and what stays in one stays in
the other; other rows of that key, or without key, lose their own lines only.
Rows without key come last. A column with the name of a result column is replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.components import components
from lexiquarry.llm.rows import discard, per_text, raw_bytes, settle
from lexiquarry.llm.simhash import SETS_APART, Forest, blocks_of, deal, deal_groups, fingerprint_of, joined_tries, trie_join, trie_of
from lexiquarry.llm.words import Words, mix, words_in, words_of

MIN_WORDS = 5
MAX_BITS = 4
SIMILARITY = 0.8
MOST = 4096
PRINTS = 1
NEWLINE = 10


def line_offsets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each line begins (one more at the end), and the first line of each text (one more at the end).

    A line begins with its text or with a newline character, which is no word.
    """
    breaks = np.flatnonzero(raw == NEWLINE)
    starts = np.sort(np.concatenate((offsets[:-1], breaks)), kind="stable")
    lines = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.concatenate(([0], np.cumsum(lines)))
    return np.append(starts, len(raw)), first


def lengths(words: Words) -> np.ndarray:
    """For each word one, or the number of its characters of scripts without spaces."""
    out = np.ones(len(words), np.int64)
    data = words.data
    at = np.flatnonzero(data >= 0xE0)
    at = at[at < len(data) - 1]
    if len(at):
        a, b = data[at], data[at + 1]
        # Thai and Lao, Myanmar, Khmer, radicals to ideographs but U+3000 to U+303F, compatibility and later ideographs.
        unspaced = (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)
        unspaced |= (a == 0xE1) & ((b >= 0x80) & (b <= 0x82) | (b >= 0x9E) & (b <= 0x9F))
        unspaced |= (a == 0xE2) & (b >= 0xBA) | (a == 0xE3) & (b >= 0x81) | (a >= 0xE4) & (a <= 0xE9)
        unspaced |= (a == 0xEF) & (b >= 0xA4) & (b <= 0xAB) | (a == 0xF0) & (b >= 0xA0) & (b <= 0xB3)
        own = np.searchsorted(words.ends, at[unspaced], "right") - 1
        out = np.maximum(out, np.bincount(own, minlength=len(words)))
    return out


def lines_in(texts: pa.Array, min_words: int) -> tuple:
    """Words by line, their hashes, the first line of each text, the lines that count, two hashes and words of every line."""
    raw, offsets = raw_bytes(texts)
    starts, first = line_offsets(raw, offsets)
    words = words_in(raw, starts)
    # A line that begins at the same byte as an empty text before it belongs to the later one.
    line = words.text
    size = np.bincount(line, minlength=len(starts) - 1)
    long = np.bincount(line, lengths(words), len(starts) - 1).astype(np.int64)
    begin = np.cumsum(size) - size
    hashes = words.hashes()
    nth = (np.arange(len(line)) - begin[line]).astype(np.uint64)
    placed = [mix(hashes + (nth + np.uint64(1)) * np.uint64(k)) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
    keep = np.flatnonzero(long >= max(min_words, 1))
    filled = np.flatnonzero(size)
    sums = [np.zeros(len(size), np.uint64) for _ in placed]
    for total, p in zip(sums, placed, strict=True):
        if len(filled):
            total[filled] = np.add.reduceat(p, begin[filled])
    return words, hashes, first, keep, sums, long


def line_marks(texts: pa.Array, min_words: int, prints: int = 1) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each text how many lines count, and for each such line: its number, two hashes, its words and its SimHashes."""
    words, hashes, first, keep, sums, long = lines_in(texts, min_words)
    if not len(keep):
        return np.zeros(len(texts), np.int64), [np.zeros(0, np.int64)] * (4 + prints)
    # Distinct words: with repeats, the few commonest words of a language would make unlike lines candidates.
    values, owner = distinct_in(words.text, mix(hashes)) if prints else (hashes, words.text)
    found = []
    for k in range(prints):
        seeded = values if not k else mix(values + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
        found.append(fingerprint_of(seeded, owner, words.texts)[keep].view(np.int64))
    text = np.searchsorted(first, keep, "right") - 1
    marks = [keep - first[text], *(t[keep].view(np.int64) for t in sums), long[keep], *found]
    return np.bincount(text, minlength=len(texts)), marks


def distinct_in(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each owner, and their owners in order."""
    if not len(values):
        return values, owner
    coded = pa.array(values).dictionary_encode()
    known = coded.dictionary.to_numpy()
    # Owner and place in the dictionary as one number: plain numbers are sorted fastest.
    bits = len(known).bit_length()
    both = np.sort(owner << bits | coded.indices.to_numpy())
    both = both[np.append(True, both[1:] != both[:-1])]
    return known[both & ((1 << bits) - 1)], both >> bits


def marked_lines(docs: DataFrame, key: str, text: str, min_words: int, short: bool = False, prints: int = 1) -> DataFrame:
    """(key, body, line, high, low, print0, print1 ...) of every line that counts; body is the hash of its row's text.

    Lines that are too short to be compared come along with `short`, without SimHashes.
    """
    names = [f"print{k}" for k in range(prints)]

    def make():
        def of(texts: pa.Array) -> list[pa.Array]:
            many, (line, high, low, long, *found) = line_marks(texts, 1 if short else min_words, prints)
            cols = [*(pa.array(m) for m in (line, high, low)), *(pa.array(f, mask=long < min_words) for f in found)]
            ends = np.concatenate(([0], np.cumsum(many))).astype(np.int32)
            rows = pa.StructArray.from_arrays(cols, ["line", "high", "low", *names])
            return [pa.ListArray.from_arrays(pa.array(ends), rows)]

        return of

    fields = f"lines array<struct<line:long,high:long,low:long,{','.join(f'{n}:long' for n in names)}>>"
    rows = per_text(known(docs, key, text), make, fields, "text", ["key", "body"])
    return rows.select("key", "body", F.inline("lines"))


def known(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, body) of each row."""
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return plain.withColumn("body", F.xxhash64("text"))


def normal(line: str) -> str:
    """The lower-cased words of a line with one space between."""
    return normals(pa.array([line]))[0].as_py()


def normals(lines: pa.Array) -> pa.Array:
    """`normal` of many lines at once."""
    words = words_of(lines)
    ends = pa.array(np.concatenate(([0], np.cumsum(words.counts()))))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(ends, words.arrow()), pa.scalar(b" ", pa.large_binary()))
    return joined.cast(pa.large_string()).cast(pa.string())


def distance(a: str, b: str, most: int) -> int:
    """Edit distance if it is at most `most`, else more than that; bit-parallel, after equal ends are cut off."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    ends = []
    for x, y in ((a, b), (a[::-1], b[::-1])):
        low, high = 0, len(x)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if x[low:mid] == y[low:mid] else (low, mid - 1)
        ends.append(low)
    front, back = ends[0], min(ends[1], len(a) - ends[0])
    a, b = a[front : len(a) - back], b[front : len(b) - back]
    if not a:
        return len(b)
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    whole, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score, left = whole, 0, len(a), len(b)
    for c in b:
        same = at.get(c, 0)
        v = same | down
        h = (((same & up) + up) ^ up) | same
        plus, minus = down | ~(h | up) & whole, up & h
        score += 1 if plus & top else -1 if minus & top else 0
        left -= 1
        if score - left > most:
            return most + 1
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~(v | plus)) & whole, plus & v & whole
    return score


def alike(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    most = int(longest * (1 - similarity) + 1e-9)
    return distance(a, b, most) <= most


def verify(a: np.ndarray, b: np.ndarray, texts: list[str], forest: Forest, similarity: float) -> None:
    """Link the candidates that are alike, as far as they join groups.

    In each turn every group puts forward one candidate that leads out of it;
    what is refuted is not asked again.
    """
    while len(a):
        ra, rb = forest.roots(a), forest.roots(b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            return
        _, chosen = np.unique(np.maximum(ra, rb), return_index=True)
        good = np.array([alike(texts[x], texts[y], similarity) for x, y in zip(a[chosen], b[chosen], strict=True)], bool)
        forest.link(a[chosen[good]], b[chosen[good]])
        rest = np.ones(len(a), bool)
        rest[chosen] = False
        a, b = a[rest], b[rest]


def with_candidates(simhashes: DataFrame, max_bits: int, most: int) -> DataFrame:
    """(trie, simhash) of the fingerprints (which, simhash) that have another of their set within max_bits in that trie."""

    def join(batches):
        got = [[b.column(c).to_numpy() for c in ("trie", "part", "simhash")] for b in batches]
        if got:
            trie, part, fp = (np.concatenate(x) for x in zip(*got, strict=True))
            for own, group, turned, width in joined_tries(trie, part, fp.view(np.uint64), max_bits):
                met = np.zeros(len(own), bool)

                def near(a, b, met=met):
                    met[a] = met[b] = True

                trie_join(group, turned, width, max_bits, near)
                at = own[met]
                yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (trie, fp)], ["trie", "simhash"])

    dealt = deal(simhashes.select("which", "simhash"), max_bits, most)
    return dealt.select("trie", "part", "simhash").mapInArrow(join, "trie long, simhash long")


def verified_links(placed: DataFrame, max_bits: int, similarity: float, most: int) -> DataFrame:
    """Links (a, b) of nodes whose lines are candidates and alike; `placed` has trie, simhash, node and text."""

    def join(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            columns = ("trie", "part", "simhash", "node")
            trie, part, fp, node = (np.concatenate([b.column(c).to_numpy() for b in got]) for c in columns)
            texts = pa.chunked_array([b.column("text") for b in got])
            cuts = blocks_of(max_bits)
            for own, group, turned, width in joined_tries(trie, part, fp.view(np.uint64), max_bits):
                forest = Forest(len(own))
                here = pa.array(own)
                lines = texts.take(here).to_pylist()
                bits, earlier = fp.view(np.uint64)[own], cuts[: (int(trie[own[0]]) >> 40) % SETS_APART]

                def near(a, b, forest=forest, lines=lines, bits=bits, earlier=earlier):
                    # Candidates that agree on an earlier block, too, have met there.
                    apart = bits[a] ^ bits[b]
                    new = a < b
                    for first, size in earlier:
                        new &= (apart >> np.uint64(64 - first - size)) & np.uint64((1 << size) - 1) != 0
                    verify(a[new], b[new], lines, forest, similarity)

                trie_join(group, turned, width, max_bits, near)
                for a, b in forest.links:
                    yield pa.RecordBatch.from_arrays([pa.array(node[own[x]]) for x in (a, b)], ["a", "b"])

    return deal_groups(placed, most).select("trie", "part", "simhash", "node", "text").mapInArrow(join, "a long, b long")


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Normalised texts of the wanted lines (key, body, line, high, low, node), with what else `wanted` has."""
    rest = [c for c in wanted.columns if c not in ("key", "body", "line", "high", "low")]
    by_doc = wanted.groupBy("key", "body").agg(F.collect_list(F.struct("line", "high", "low", *rest)).alias("lines"))
    by_doc = by_doc.withColumnsRenamed({"key": "in", "body": "of"})
    lines = F.split("text", "\n", -1)
    found = F.transform(
        "lines",
        lambda x: F.struct(
            F.get(lines, x["line"].cast("int")).alias("text"), *(x[c].alias(c) for c in ("high", "low", *rest))
        ),
    )
    raw = docs.join(by_doc, docs["key"].eqNullSafe(by_doc["in"]) & (docs["body"] == by_doc["of"])).select(F.inline(found))

    def clean(batches):
        for b in batches:
            # Only the line that was marked counts, should two texts of one key have the same hash.
            many, (_, high, low, *_) = line_marks(b.column("text"), 1, 0)
            right = many == 1
            right[right] = (b.column("high").to_numpy()[right] == high) & (b.column("low").to_numpy()[right] == low)
            b = b.filter(pa.array(right))
            yield pa.RecordBatch.from_arrays([normals(b.column("text")), *(b.column(c) for c in rest)], ["text", *rest])

    return raw.mapInArrow(clean, raw.select("text", *rest).schema).dropDuplicates(["node"])


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    min_words: int = MIN_WORDS,
    max_bits: int = MAX_BITS,
    similarity: float = SIMILARITY,
    most: int = MOST,
    prints: int = PRINTS,
    short: bool = False,
) -> DataFrame:
    """Kept columns (default all) with the lines that stay in `text`, and n_lines and n_removed."""
    keep = list(docs.columns if keep is None else keep)
    plain = known(docs, key, text)
    lines = settle(marked_lines(docs, key, text, min_words, short, prints), "lines")
    place = F.struct(F.col("key").isNull().alias("last"), "key", "body", "line")
    # Counts and least numbers need no sorting. The least of each part is a place if there is one only.
    names = [f"print{k}" for k in range(prints)]
    distinct = lines.groupBy("high", "low").agg(*(F.min(c).alias(c) for c in ("key", "body", "line", *names)), F.count("*").alias("many"))
    distinct = settle(distinct, "distinct")
    again = lines.join(distinct.where("many > 1").select("high", "low"), ["high", "low"])
    again = settle(again.select("high", "low", "key", "body", "line"), "again")
    discard(lines)
    repeated = settle(again.groupBy("high", "low").agg(F.min(place).alias("first")), "repeated")

    each = distinct.where("print0 IS NOT NULL")
    each = each.select("high", "low", "key", "body", "line", F.posexplode(F.array(*names)).alias("which", "simhash"))
    marks = settle(each.groupBy("which", "simhash").count(), "marks")
    near = with_candidates(marks, max_bits, most)
    # Lines of one fingerprint meet in any one trie.
    shared = marks.where("count > 1")
    shared = shared.select(trie_of(0, *blocks_of(max_bits)[0], F.col("which")).alias("trie"), "simhash")
    near = settle(near.unionByName(shared).groupBy("simhash").agg(F.collect_set("trie").alias("tries")), "near")
    meets = F.transform("tries", lambda t: F.struct(t.alias("trie"), F.col("simhash").alias("simhash")))
    asked = each.join(near, "simhash").select("high", "low", place.alias("place"), meets.alias("meets"))
    if prints > 1:
        both = F.flatten(F.collect_list("meets")).alias("meets")
        asked = asked.groupBy("high", "low").agg(F.first("place").alias("place"), both)
    asked = asked.join(repeated, ["high", "low"], "left").withColumn("place", F.coalesce("first", "place"))
    # Stored once, so a line's number stays.
    asked = settle(asked.select("high", "low", "place", "meets", F.monotonically_increasing_id().alias("node")), "asked")
    discard(marks, near, distinct)
    texts = settle(fetched(plain, asked.select("place.key", "place.body", "place.line", "high", "low", "node", "meets")), "texts")
    placed = texts.select(F.inline("meets"), "node", "text")
    found = verified_links(placed, max_bits, similarity, most)
    found = settle(found, "links")
    groups = settle(components(found), "groups")
    discard(texts, found)
    members = settle(groups.join(asked.select("node", "high", "low", "place"), "node"), "members")
    firsts = settle(members.groupBy("root").agg(F.min("place").alias("stays")), "firsts")
    joined = settle(members.join(firsts, "root").select("high", "low", "place", "stays"), "joined")
    discard(groups, asked, members, firsts)

    # Only lines that are repeated or in a group can lose an occurrence.
    named = repeated.join(joined.select("high", "low", "stays"), ["high", "low"], "left")
    # Stored, so that the next join is alone in its stage, where a very common line is split.
    named = settle(named.select("high", "low", F.coalesce("stays", "first").alias("stays")), "named")
    gone = again.join(named, ["high", "low"]).select(place.alias("place"), "stays")
    gone = gone.unionByName(joined.select("place", "stays")).where(F.col("place") != F.col("stays"))
    gone = gone.select("place.key", "place.body", "place.line").distinct()
    by_doc = gone.groupBy("key", "body").agg(F.collect_list("line").alias("__gone"))
    by_doc = settle(by_doc.withColumnsRenamed({"key": "__key", "body": "__body"}), "gone")
    discard(again, repeated, joined, named)

    # Under names of their own, so that no column of the input can clash.
    shown = [c for c in keep if c not in ("n_lines", "n_removed")]
    own = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([*shown, key, text]))}
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()))
    body = F.xxhash64(F.col(own[text]).cast("string"))
    both = rows.join(by_doc, F.col(own[key]).eqNullSafe(F.col("__key")) & (body == F.col("__body")), "left")
    split = F.split(F.col(own[text]), "\n", -1)
    left = F.array_join(F.filter(split, lambda _, i: ~F.array_contains(F.col("__gone"), i.cast("long"))), "\n")
    stays = F.when(F.col("__gone").isNull(), F.col(own[text])).otherwise(left)
    return both.select(
        *((stays if c == text else F.col(own[c])).alias(c) for c in shown),
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
