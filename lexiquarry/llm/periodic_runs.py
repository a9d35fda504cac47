"""Periodic runs of words: stretches in which a few words come again and again.

A run is a stretch of consecutive words with smallest period q (words q apart
are the same) of at least `least` words and at least `times` periods, which no
neighbouring word extends. Every run of a text is found, of any period.

Found by recursive frequency splitting. A word of a run occurs at least `times`
times in it, so a word that occurs less often in its segment is in no run of
that segment and splits it. The parts are counted anew until none is split any
more; what survives of ordinary prose is little. The surviving segments are
scanned lag by lag: compared with themselves shifted by q words, the stretches
of equal words are the runs. A lag is scanned only if blocks of words recur at
it (in a run of period q, a block of B words, q < B <= 2q, first recurs q words
on), so a long segment costs no comparison of all its lags. A stretch that a
smaller lag has found already has that smaller period.

Rows are mapped where they lie, whole texts at a time; nothing is shuffled.

Defined cases: words are what spaces and the five ASCII line and tab characters
separate; all else, other scripts' spaces included, belongs to words, and case
counts. Null and wordless texts have no runs and collapse to the empty text.
Repeated rows each get a row; a null key is kept as it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.rows import per_text, raw_bytes
from lexiquarry.llm.words import Words, byte_set, words_in

LEAST = 6
TIMES = 4

# Fixed value: all bytes but the space and the characters 9 to 13.
NOT_SPACE = byte_set((0x00, 0x08), (0x0E, 0x1F), (0x21, 0xFF))
AS_IT_IS = np.arange(256, dtype=np.uint8)
SPACE = np.uint8(0x20)

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _edges(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of true."""
    turn = np.diff(np.concatenate(([False], same, [False])).astype(np.int8))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def split_segments(word: np.ndarray, text: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the segments in which every word occurs at least `times` times.

    `word` numbers the words, `text` (ascending) the texts. Only segments that
    were split are counted again.
    """
    at, segment = np.arange(len(word)), text.astype(np.int64)
    stable = []
    base = int(word.max()) + 1 if len(word) else 1
    while len(at):
        _, which, many = np.unique(segment * base + word[at], return_inverse=True, return_counts=True)
        rare = many[which] < times
        split = np.bincount(segment[rare], minlength=segment[-1] + 1) > 0
        whole = ~split[segment]
        if whole.any():
            first = np.flatnonzero(whole & np.concatenate(([True], segment[1:] != segment[:-1])))
            size = np.bincount(segment[whole])
            stable.append(np.stack([at[first], at[first] + size[size > 0]]))
        left = ~rare & ~whole
        at, segment = at[left], segment[left]
        if not len(at):
            break
        new = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(segment) != 0)))
        number = np.cumsum(new) - 1
        long = np.bincount(number)[number] >= least
        at, number = at[long], number[long]
        segment = np.cumsum(np.concatenate(([0], np.diff(number) > 0))) if len(at) else number
    if not stable:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = np.concatenate(stable, axis=1)
    long = end - begin >= least
    order = np.argsort(begin[long])
    return begin[long][order], end[long][order]


def recurring_lags(
    word: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int, times: int
) -> list[tuple[int, int]]:
    """(segment, lag), by lag, where blocks of words recur over so many words that a run may be there."""
    found: list[tuple[int, int]] = []
    size = end - begin
    segment = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(segment)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    name = np.unique(segment * (int(word.max()) + 1) + word[at], return_inverse=True)[1] if len(at) else at
    block = 1
    while True:
        # Blocks of twice as many words, in the segments that are long enough for the lags block to 2 block - 1.
        alive = size[segment] >= max(least, times * block)
        segment, at, name = segment[alive], at[alive], name[alive]
        if not len(at):
            return found
        whole = np.flatnonzero(at + 2 * block <= end[segment])
        pair = name[whole] * (int(name.max()) + 1) + name[whole + block]
        name = np.zeros(len(at), np.int64)
        name[whole] = np.unique(pair, return_inverse=True)[1]
        order = whole[np.argsort(name[whole], kind="stable")]
        block *= 2
        lag = np.zeros(len(at), np.int64)
        again = name[order[1:]] == name[order[:-1]]
        lag[order[:-1][again]] = (order[1:] - order[:-1])[again]
        lag[(lag < block // 2) | (lag >= block)] = 0
        edge = np.flatnonzero(np.concatenate(([True], (lag[1:] != lag[:-1]) | (segment[1:] != segment[:-1]))))
        many, own = np.diff(np.append(edge, len(lag))), lag[edge]
        enough = (own > 0) & (many >= np.maximum(least, times * own) - own - block + 1)
        found += sorted(set(zip(own[enough].tolist(), segment[edge[enough]].tolist(), strict=True)))
        if not len(whole):
            return found


def runs_of(word: np.ndarray, text: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (first word, length, period) of all runs, by first word, then period."""
    begin, end = split_segments(word, text, least, times)
    found: dict[tuple[int, int], int] = {}
    for lag, segment in recurring_lags(word, begin, end, least, times):
        own = word[begin[segment] : end[segment]]
        first, last = _edges(own[lag:] == own[:-lag])
        long = last - first >= max(least, times * lag) - lag
        for a, b in zip((begin[segment] + first[long]).tolist(), (begin[segment] + last[long] + lag).tolist(), strict=True):
            found.setdefault((a, b), lag)  # lags ascend: the first is the smallest period
    rows = sorted((a, q, b - a) for (a, b), q in found.items())
    return np.array([(a, n, q) for a, q, n in rows], np.int64).reshape(-1, 3)


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    own = np.flatnonzero(kept)
    text = words.text[own]
    size = words.ends[own + 1] - words.ends[own] + 1  # with the space behind
    ends = np.cumsum(size)
    last = np.concatenate((text[1:] != text[:-1], [True])) if len(own) else np.zeros(0, bool)
    from_ = np.repeat(words.ends[own] - (ends - size), size) + np.arange(int(size.sum()))
    data = np.append(words.data, SPACE)[np.minimum(from_, len(words.data))]
    data[ends - 1] = SPACE
    keep = np.ones(len(data), bool)
    keep[ends[last] - 1] = False
    many = np.bincount(text, weights=size, minlength=words.texts).astype(np.int64)
    many -= np.bincount(text[last], minlength=words.texts).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(many)))
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[keep])]
    return pa.LargeStringArray.from_buffers(words.texts, *buffers[1:]).cast(pa.string())


def find_runs(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """Kept columns (default all), `runs` and `collapsed`.

    `runs` has (start, length, period), counted in words, by start, then
    period. `collapsed` is the text without the words of a run that come after
    its first period, its words joined by one space. `times` is 3 at least.
    """
    if times < 3 or least < 1:
        raise ValueError("a run has three periods and one word at least")

    def make():
        def of(texts: pa.Array) -> list[pa.Array]:
            words = words_in(*raw_bytes(texts), NOT_SPACE, AS_IT_IS)
            if not len(words):
                empty = pa.ListArray.from_arrays(np.zeros(len(texts) + 1, np.int32), pa.array([], RUN))
                return [empty, pa.array([""] * len(texts), pa.string())]
            numbers = words.arrow().dictionary_encode().indices.to_numpy().astype(np.int64)
            found = runs_of(numbers, words.text, least, times)
            begin, length, period = found.T
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, begin + period, 1)
            np.add.at(change, begin + length, -1)
            owner = words.text[begin]
            offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=words.texts))))
            start = begin - np.searchsorted(words.text, owner)
            rows = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(RUN))
            runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
            return [runs, _joined(words, np.cumsum(change[:-1]) == 0)]

        return of

    fields = "runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return per_text(docs, make, fields, text, keep)


def repeating(key: str = "doc_id", text: str = "text") -> Column:
    """Texts of which some are given a periodic tail, chosen and shaped by a checksum of the key.

    Of h, the crc32 of the key in decimals, the last digit says whether (0), and
    the others where the tail begins and how long its period is. A text without
    words, and any of a null key, stays as it is.
    """
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))

    def tail(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")

    wordy = F.coalesce(F.col(f"`{text}`").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    # One element, so that the words are worked out once.
    changed = F.get(F.transform(F.array(words), tail), F.lit(0))
    return F.when((h % 10 == 0) & wordy, changed).otherwise(F.col(f"`{text}`"))


def digest(found: DataFrame, keep: list[str]) -> DataFrame:
    """Kept columns, number of runs, the longest one, and digests of all runs and of the collapsed text."""
    order = lambda r: F.struct(-r["length"], r["start"], r["period"])
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(order(r).alias("o"), r.alias("r")))), F.lit(0))["r"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    named = found.withColumn("best", best)
    return named.select(
        *keep,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
