"""Quality scores by naive Bayes support vectors.

A text is the set of its n-grams: of words, and of word shapes (case, digits,
marks at the end, length, and whether the word is that of one or two places
before). Each indicator is scaled by its log-count ratio, the log of how much
likelier a good text has it than a bad one, and a linear model is fitted on the
scaled indicators with hinge loss by dual coordinate descent. A logistic curve
fitted to the margins of rows left out of the fit turns them into scores.

n-grams are hashed to 2^18 buckets. The classifier is fitted on a bounded sample
of the labelled rows, at most `SAMPLE_ROWS` (`sampled`, half from either class,
those of the smallest hash of their key): labels are sampled before they meet
the texts, so no text is shuffled. Ratios come from the counts of all sampled
rows, summed where the rows are; they are two numbers a bucket. The curve and the
constant answer for the shares of good and bad among all labelled rows
(`totals`), whatever the sample holds of either. The linear model
is fitted on at most `FIT_ROWS` training rows, distinct texts of the smallest
hash, half from either class, a documented bound, with every n-gram of their
whole texts, as in scoring; the driver holds these, 4 bytes each.

Defined cases: null and empty texts have no n-grams and get the score of the
bias alone. Rows without label teach nothing; contradicting labels each count.
With one class or none in training every score is the share of good rows (0.5
without any). Scores do not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.rows import per_text, raw_bytes
from lexiquarry.llm.words import byte_set, mix, words_in

BITS = 18
SAMPLE_ROWS = 20_000
FIT_ROWS = 6000
THRESHOLD = 0.3
NOT_SPACE = ~byte_set((0x00, 0x20), (0x7F, 0x7F))
LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
UPPER = byte_set((0x41, 0x5A))
DIGIT = byte_set((0x30, 0x39))


def grams(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct n-grams of each text, sorted."""
    raw, offsets = raw_bytes(texts)
    words = words_in(raw, offsets, NOT_SPACE)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = raw[NOT_SPACE[raw]]
    starts, size = words.ends[:-1], np.diff(words.ends)
    upper = np.add.reduceat(UPPER[inside].astype(np.int64), starts)
    letter = np.add.reduceat(LETTER[inside].astype(np.int64), starts)
    digit = np.add.reduceat(DIGIT[inside].astype(np.int64), starts)
    last = inside[words.ends[1:] - 1].astype(np.int64)
    word = words.hashes()

    def before(k: int) -> np.ndarray:
        """Whether the word k places before is in the same text."""
        out = np.zeros(n, bool)
        out[k:] = words.text[k:] == words.text[:-k]
        return out

    again = np.zeros(n, np.int64)
    for k in (2, 1):
        same = np.zeros(n, bool)
        same[k:] = word[k:] == word[:-k]
        again[same & before(k)] = k
    case = np.where(upper == 0, 0, np.where(upper == letter, 2, 1))
    marks = np.minimum(size - letter - digit, 3)
    shape = np.where(LETTER[last] | DIGIT[last], 0, last)
    for part, base in ((case, 3), (marks, 4), (np.minimum(digit, 2), 3), (np.minimum(size, 31) // 4, 8), (again, 3)):
        shape = shape * base + part
    shape = shape.astype(np.uint64)
    found = [(word, np.ones(n, bool), 1), (shape, np.ones(n, bool), 2)]
    for values, longest, kind in ((word, 2, 3), (shape, 3, 4)):
        joined = values
        for k in range(1, longest):
            shifted = np.zeros(n, np.uint64)
            shifted[k:] = values[:-k]
            joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + shifted)
            found.append((joined, before(k), kind + 16 * k))
    keys = []
    for values, there, kind in found:
        salt = np.uint64(kind * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
        bucket = mix(values + salt)[there] >> np.uint64(64 - bits)
        keys.append(words.text[there] << bits | bucket.astype(np.int64))
    distinct = np.unique(np.concatenate(keys))
    return distinct >> bits, distinct & ((1 << bits) - 1)


@dataclass
class Model:
    weights: np.ndarray  # by bucket, log-count ratio included
    bias: float
    slope: float
    shift: float
    constant: float | None = None

    def margins(self, texts: pa.Array) -> np.ndarray:
        text, bucket = grams(texts)
        size = np.sqrt(np.maximum(np.bincount(text, minlength=len(texts)), 1))
        return np.bincount(text, self.weights[bucket], len(texts)) / size + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -500, 500)))


def marked(labels: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label) of the labelled rows, the label 1 or 0."""
    own = labels.select(F.col(f"`{key}`").alias(key), (F.col(f"`{label}`") > 0).cast("long").alias(label))
    return own.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull())


def totals(labels: DataFrame, key: str = "doc_id", label: str = "label") -> tuple[int, int]:
    """How many of all labelled rows are bad, and how many good."""
    many = {r[label]: r["count"] for r in marked(labels, key, label).groupBy(f"`{label}`").count().collect()}
    return many.get(0, 0), many.get(1, 0)


def sampled(
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "label",
    rows: int = SAMPLE_ROWS,
    many: tuple[int, int] | None = None,
) -> DataFrame:
    """(key, label) of at most so many labelled rows, half of them from either class, as far as there are."""
    own = marked(labels, key, label)
    many = totals(labels, key, label) if many is None else many
    mark = F.xxhash64(F.col(f"`{key}`"), F.lit(11))
    each = []
    for c in (0, 1):
        share = min(1.0, rows / max(many[c], 1))
        thin = own.where((F.col(label) == c) & (F.shiftrightunsigned(mark, 32) < int(share * 2**32)))
        each.append(thin.orderBy(mark, F.col(f"`{key}`")).limit(rows // 2))
    return each[0].unionByName(each[1])


def fit(
    training: DataFrame,
    text: str = "text",
    label: str = "label",
    rows: int = FIT_ROWS,
    whole: tuple[int, int] | None = None,
) -> Model:
    """The model of texts and their labels (1 good, 0 bad); `whole` are the `totals` that a sample stands for."""
    plain = training.select(
        F.col(f"`{text}`").cast("string").alias("text"), (F.col(f"`{label}`") > 0).cast("long").alias("label")
    ).where("label is not null")

    def counted(batches):
        sums = np.zeros((2, (1 << BITS) + 1), np.int64)
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for at in range(0, batch.num_rows, 256):
                own, (row, bucket) = labels[at : at + 256], grams(batch.column("text").slice(at, 256))
                for c in (0, 1):
                    sums[c, :-1] += np.bincount(bucket[own[row] == c], minlength=1 << BITS)
                    sums[c, -1] += int((own == c).sum())
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(sums[0, used]), pa.array(sums[1, used])], ["bucket", "bad", "good"]
        )

    sums = plain.mapInArrow(counted, "bucket long, bad long, good long").groupBy("bucket")
    # At most 2^18 + 1 rows, as Arrow.
    got = sums.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()
    counts = np.zeros((2, (1 << BITS) + 1))
    at = got.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = got.column("bad").to_numpy(), got.column("good").to_numpy()
    many = counts[:, -1]
    whole = many if whole is None else np.array(whole, float)
    if not many.all():
        share = whole[1] / whole.sum() if whole.sum() else 0.5
        return Model(np.zeros(1 << BITS), 0.0, 1.0, 0.0, float(share))
    ratio = np.log((counts[1, :-1] + 1) / (many[1] + 2)) - np.log((counts[0, :-1] + 1) / (many[0] + 2))

    def hashed(batches):
        """The n-grams of each row."""
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                row, bucket = grams(batch.column("text").slice(at, 256))
                ends = np.searchsorted(row, np.arange(len(batch.column("text").slice(at, 256)) + 1))
                out += [bucket[a:b].astype(np.int32) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            x = pa.array(out, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("mark"), batch.column("label"), x], ["mark", "y", "x"])

    # Up to half of the rows from either class: distinct texts of small hash, thinned where they are, then cut to the bound.
    each = []
    for c in (0, 1):
        own = plain.where(F.col("label") == c).withColumn("mark", F.xxhash64("text"))
        share = min(1.0, 0.75 * rows / many[c])
        thin = own.where(F.shiftrightunsigned("mark", 32) < int(share * 2**32)).dropDuplicates(["mark"])
        each.append(thin.mapInArrow(hashed, "mark long, y long, x array<int>").orderBy("mark").limit(rows // 2))
    sample = each[0].unionByName(each[1]).toArrow()
    y = sample.column("y").to_numpy() * 2 - 1
    x = [np.asarray(v) for v in sample.column("x").combine_chunks().to_numpy(zero_copy_only=False)]
    return fit_margin(x, y, ratio, whole)


def fit_margin(x: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, many: np.ndarray) -> Model:
    """The linear model on one half of the rows and its curve on the other, then the model on all."""
    order = np.random.default_rng(5).permutation(len(y))
    part = order % 4 == 0
    fold = [k for k in range(len(y)) if not part[k]], [k for k in range(len(y)) if part[k]]
    weights, bias = descend([x[k] for k in fold[0]], y[fold[0]], ratio)
    margin = np.array([margin_of(x[k], weights, bias, ratio) for k in fold[1]])
    # The sample is balanced; the curve answers for the shares of the whole.
    rows = np.where(y[fold[1]] > 0, many[1] / max((y[fold[1]] > 0).sum(), 1), many[0] / max((y[fold[1]] < 0).sum(), 1))
    slope, shift = curve(margin, y[fold[1]] > 0, rows / rows.sum())
    weights, bias = descend(x, y, ratio)
    return Model(weights * ratio, bias, slope, shift)


def margin_of(x: np.ndarray, weights: np.ndarray, bias: float, ratio: np.ndarray) -> float:
    return float((weights[x] * ratio[x]).sum() / np.sqrt(max(len(x), 1)) + bias)


def descend(x: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0, rounds: int = 12):
    """Dual coordinate descent for the L1 hinge loss; rows are scaled by the root of their length, with a constant one."""
    weights, bias = np.zeros(len(ratio)), 0.0
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in x]
    norm = np.array([(v * v).sum() + 1 for v in values])
    alpha = np.zeros(len(x))
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        moved = 0.0
        for k in rng.permutation(len(x)):
            slack = y[k] * (weights[x[k]] @ values[k] + bias) - 1
            new = min(max(alpha[k] - slack / norm[k], 0.0), cost)
            step = new - alpha[k]
            if step:
                weights[x[k]] += step * y[k] * values[k]
                bias += step * y[k]
                alpha[k] = new
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost:
            break
    return weights, bias


def curve(margin: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps with a little ridge."""
    a, b = 1.0, 0.0
    if not len(margin):
        return a, b
    weight = weight * len(margin)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        g = weight * (p - good)
        h = weight * p * (1 - p) + 1e-9
        grad = np.array([(g * margin).sum() + 1e-2 * a, g.sum()])
        hess = np.array([[(h * margin * margin).sum() + 1e-2, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def score(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Kept columns (default all), score (0 to 1) and predicted (1 if the score reaches the threshold)."""
    # 2^18 weights whatever the corpus: 2 MB.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def of(texts: pa.Array) -> list[pa.Array]:
            s = sent.value.scores(texts)
            return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

        return of

    return per_text(docs, make, "score double, predicted int", text, keep, 2 << 20)


def learns(key: str = "doc_id"):
    """Whether a row may teach: crc32 of its key as text, modulo 5, is not 0."""
    return F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 != 0
