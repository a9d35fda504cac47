"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of letters is bound into
one vector by permuting (rotating) each letter's vector by its place in the run
and multiplying them; a text is the sum of the vectors of its n-grams, and a
language the sum over its training texts, each text counting alike. A text gets
the language whose centred prototype is nearest by cosine.

Words are lower-cased letters with one space around them; anything else only
separates. Letters of any script take part: a vector is drawn from the letter's
code point. Prototypes are fitted on all training rows: each task sums its own,
and (language, dimension) pairs are summed up, a bounded table.

Defined cases: null and letterless texts are `und` with score 0. Rows without
language teach nothing. With no training rows at all every text is `und`.
Ties go to the language that sorts first.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.rows import per_text, raw_bytes

DIMENSIONS = 512
GRAM = 3
UNKNOWN = "und"
SPACE = 32
BLOCK = 8192  # n-grams whose vectors are multiplied at a time
STEPS = 1 << 20
SHARPNESS = 12.0  # of the score: a softmax over cosines


@functools.cache
def letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is none."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def vector(point: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([7, point]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


class Space:
    """n-gram vectors, made when first met and remembered up to a bound."""

    def __init__(self, dimensions: int = DIMENSIONS, gram: int = GRAM, kept: int = 40_000):
        self.dimensions, self.gram, self.kept = dimensions, gram, kept
        self.letter = functools.lru_cache(maxsize=20_000)(lambda p: vector(p, dimensions))
        self.rows = np.zeros((1024, dimensions), np.int8)
        self.place: dict[int, int] = {}

    def bind(self, code: int) -> np.ndarray:
        out = np.ones(self.dimensions, np.int8)
        for k in range(self.gram):
            point = code >> (21 * (self.gram - 1 - k)) & 0x1FFFFF
            out = out * np.roll(self.letter(point), self.gram - 1 - k)
        return out

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        if len(self.place) + len(codes) > self.kept and len(self.place):
            self.place, self.rows = {}, np.zeros((1024, self.dimensions), np.int8)
        at = []
        for code in codes.tolist():
            place = self.place.get(code)
            if place is None:
                place = self.place[code] = len(self.place)
                if place == len(self.rows):
                    self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
                self.rows[place] = self.bind(code)
            at.append(place)
        return self.rows[at]

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the distinct n-grams; for each n-gram in the texts, which one it is and its text."""
        raw, offsets = raw_bytes(texts)
        points, start = code_points(raw, offsets)
        low = letters()[points]
        letter = low > 0
        text = np.repeat(np.arange(len(start) - 1), np.diff(start))
        # A letter stays; of other runs the first place stays, as a space; each text begins and ends with one.
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[start[:-1][np.diff(start) > 0]] = True
        low, text = np.where(letter, low, SPACE)[keep].astype(np.int64), text[keep]
        edge = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))) if len(text) else np.zeros(0, np.int64)
        # A space after a text that ends with a letter, and before one that begins with one.
        end = np.append(edge[1:], len(text))[: len(edge)]
        trail = end[low[end - 1] != SPACE] if len(edge) else edge
        lead = edge[low[edge] != SPACE]
        at = np.concatenate((trail, lead))
        own = np.concatenate((text[trail - 1], text[lead]))
        order = np.argsort(at, kind="stable")
        low, text = np.insert(low, at[order], SPACE), np.insert(text, at[order], own[order])
        n = len(low) - self.gram + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        same = text[:n] == text[self.gram - 1 :]
        # Numbers of the letters in use make small codes, which need no sort.
        alphabet = np.flatnonzero(np.bincount(low))
        number = np.zeros(alphabet[-1] + 1, np.int64)
        number[alphabet] = np.arange(len(alphabet))
        short, base = number[low], len(alphabet)
        code = np.zeros(n, np.int64)
        for k in range(self.gram):
            code = code * base + short[k : k + n]
        code = code[same]
        if base**self.gram <= 1 << 22:
            distinct = np.flatnonzero(np.bincount(code))
            place = np.zeros(base**self.gram, np.int64)
            place[distinct] = np.arange(len(distinct))
            which = place[code]
        else:
            distinct, which = np.unique(code, return_inverse=True)
        wide, rest = np.zeros(len(distinct), np.int64), distinct
        for k in range(self.gram):
            wide |= alphabet[rest % base] << (21 * k)
            rest = rest // base
        return wide, which, text[:n][same]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sums of n-gram vectors of each text, and whether it has any letter."""
        distinct, which, text = self.codes(texts)
        out = np.zeros((len(texts), self.dimensions), np.float32)
        ends = np.searchsorted(text, np.arange(len(texts) + 1))
        # Counts of some texts by some n-grams, times the vectors of these.
        for low in range(0, len(distinct), BLOCK):
            part = self.vectors(distinct[low : low + BLOCK]).astype(np.float32)
            for first in range(0, len(texts), 64):
                last = min(first + 64, len(texts))
                own = slice(ends[first], ends[last])
                at = which[own] - low
                inside = (at >= 0) & (at < len(part))
                cell = ((text[own] - first) * len(part) + at)[inside]
                counts = np.bincount(cell, minlength=(last - first) * len(part)).astype(np.float32)
                out[first:last] += counts.reshape(last - first, len(part)) @ part
        raw, offsets = raw_bytes(texts)
        points, start = code_points(raw, offsets)
        seen = np.concatenate(([0], np.cumsum(letters()[points] > 0)))
        return out, seen[start[1:]] > seen[start[:-1]]


def code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 texts, and where each text begins among them."""
    first = (raw & 0xC0) != 0x80
    counts = np.concatenate(([0], np.cumsum(first)))
    return np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), counts[offsets]


def unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=-1, keepdims=True))
    return np.where(size > 0, x / np.where(size > 0, size, 1), 0)


def fit(
    training: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, gram: int = GRAM
) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their prototypes: sums of the unit vectors of all their texts."""
    plain = training.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))

    def bundle(batches):
        space, sums = Space(dimensions, gram), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                # Whole steps, so that the sum doesn't depend on how rows are dealt.
                vectors = np.rint(unit(space.texts(part.column("text"))[0].astype(np.float64)) * STEPS)
                langs = np.array(part.column("lang").to_pylist())
                for name in np.unique(langs):
                    own = vectors[langs == name].astype(np.int64).sum(axis=0)
                    sums[str(name)] = sums.get(str(name), 0) + own
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions)), pa.array(total)],
                ["lang", "dimension", "total"],
            )

    sums = plain.where("lang is not null and text is not null").mapInArrow(
        bundle, "lang string, dimension long, total long"
    )
    # At most (languages x dimensions) rows.
    rows = sums.groupBy("lang", "dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    names = sorted({r["lang"] for r in rows})
    out = np.zeros((len(names), dimensions))
    for r in rows:
        out[names.index(r["lang"]), r["dimension"]] = float(r["total"])
    return names, out


def identify(
    docs: DataFrame,
    names: list[str],
    prototypes: np.ndarray,
    text: str = "text",
    keep: list[str] | None = None,
    gram: int = GRAM,
) -> DataFrame:
    """Kept columns (default all), lang_pred, its score (0 to 1) and `cosine`, the nearness to its prototype."""
    dimensions = prototypes.shape[1] if len(names) else DIMENSIONS
    profiles = unit(prototypes)
    # What all languages share tells none apart.
    centre = profiles.mean(axis=0) if len(names) > 1 else 0
    centred = unit(profiles - centre).astype(np.float32) if len(names) else profiles

    def make():
        space = Space(dimensions, gram)

        def of(texts: pa.Array) -> list[pa.Array]:
            vectors, lettered = space.texts(texts)
            pred = np.full(len(texts), UNKNOWN, object)
            score, cosine = np.zeros(len(texts)), np.zeros(len(texts))
            if len(names):
                like = unit(unit(vectors) - centre) @ centred.T
                best = like.argmax(axis=1)
                weight = np.exp(SHARPNESS * (like - like.max(axis=1, keepdims=True)))
                pred = np.where(lettered, np.array(names, object)[best], UNKNOWN)
                score = np.where(lettered, 1 / weight.sum(axis=1), 0.0)
                cosine = np.where(lettered, like.max(axis=1), 0.0)
            return [pa.array(pred.tolist(), pa.string()), pa.array(score, pa.float64()), pa.array(cosine, pa.float64())]

        return of

    return per_text(docs, make, "lang_pred string, score double, cosine double", text, keep, 2 << 20)


def accepted():
    """Whether a language was found, and the text is nearer to it than to none."""
    return (F.col("lang_pred") != UNKNOWN) & (F.col("cosine") > 0)


def learns(key: str = "doc_id"):
    """Whether a row may teach: crc32 of its key as text, modulo 4, is not 2."""
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 != 2
