"""Main text of pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each is a vector of its tag path (tags and
the words of class, id and role, of its nearest elements and of all), its words
(hashed and summed) and a few measures (length, linked share, marks). A
bidirectional LSTM in numpy reads the whole sequence, so that each block is
labelled, as article or not, in the light of all the others.

The labeller is trained here, on `TRAIN_PAGES` pages that `html_training` sets
from the sentences of at most `SAMPLE_PAGES` pages of the table (of each its
first `SAMPLE_CHARS` characters): these are the documented bounds of its
sample. The same table gives the same model. Extraction uses every whole page.

Defined cases: null, empty and textless pages have empty text. Unclosed and
cut-off markup is read as browsers do in the main. Repeated pages each get a
row. A page whose blocks are all rejected has empty text.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.html_blocks import Block, Path, blocks
from lexiquarry.llm.html_training import Setter
from lexiquarry.llm.rows import per_text
from lexiquarry.llm.words import words_of

PATH, WORD, MEASURES = 256, 32, 8
INPUT = PATH + WORD + MEASURES
HIDDEN = 24
TRAIN_PAGES = 1500
SAMPLE_PAGES = 200
SAMPLE_CHARS = 20_000
THRESHOLD = 0.5


@functools.lru_cache(maxsize=50_000)
def entry_vector(entry: str, scope: str) -> np.ndarray:
    out = np.zeros(PATH, np.float32)
    for word in entry.split(" "):
        code = zlib.crc32(f"{scope} {word}".encode())
        out[code % PATH] += 1.0 if code & 0x80000000 else -1.0
    return out


def path_vector(place: Path | None) -> np.ndarray:
    """Hashed words of all elements of a path, and once more of its last two.

    Sums are kept with the elements of the first levels and with every 64th
    below, so that a path goes on from where one that shares it has been.
    """
    if place is None:
        return np.zeros(PATH, np.float32)
    chain, at = [], place
    while at is not None and at.sum is None:
        chain.append(at)
        at = at.up
    total = np.zeros(PATH, np.float32) if at is None else at.sum
    for at in reversed(chain):
        total = total + entry_vector(at.entry, "any")
        if at.depth < 64 or at.depth % 64 == 0:
            at.sum = total
    near = total + entry_vector(place.entry, "near")
    return near if place.up is None else near + entry_vector(place.up.entry, "near")


def vectors(page_blocks: list[list[Block]]) -> np.ndarray:
    """One row for each block of all pages."""
    flat = [b for page in page_blocks for b in page]
    x = np.zeros((len(flat), INPUT), np.float32)
    if not flat:
        return x
    words = words_of(pa.array([b.text for b in flat], pa.large_string()))
    codes = words.hashes()
    cell = words.text * WORD + (codes % np.uint64(WORD)).astype(np.int64)
    sign = np.where(codes >> np.uint64(63), 1.0, -1.0)
    bag = np.bincount(cell, sign, len(flat) * WORD).reshape(len(flat), WORD)
    many = words.counts()
    x[:, PATH : PATH + WORD] = bag / np.sqrt(np.maximum(many, 1))[:, None]
    at = 0
    for page in page_blocks:
        for k, b in enumerate(page):
            x[at, :PATH] = path_vector(b.place)
            text = b.text
            x[at, PATH + WORD :] = (
                np.log1p(len(text)) / 4,
                np.log1p(many[at]) / 3,
                b.linked,
                text[-1] in ".!?…\"”'",
                text[:1] in "©&",
                k / len(page),
                (len(page) - 1 - k) / len(page),
                np.log1p(len(page)) / 4,
            )
            at += 1
    return x


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one in each direction, and a logistic layer on both."""

    def __init__(self, seed: int = 1, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights: dict[str, np.ndarray] = {}
        for way in "fb":
            self.weights["x" + way] = rng.normal(0, 0.08, (INPUT, 4 * hidden)).astype(np.float32)
            self.weights["h" + way] = rng.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1
            self.weights["c" + way] = bias
        self.weights["o"] = rng.normal(0, 0.2, (2 * hidden + 1,)).astype(np.float32)

    def _run(self, x, live, way: str, keep: list | None):
        """States (time, pages, hidden) of one direction; x is (time, pages, input), `live` where there is a block."""
        n = self.hidden
        w, u, c = (self.weights[k + way] for k in "xhc")
        gates = x @ w + c
        h = s = np.zeros((x.shape[1], n), np.float32)
        out = np.zeros((x.shape[0], x.shape[1], n), np.float32)
        for t in range(x.shape[0]) if way == "f" else range(x.shape[0] - 1, -1, -1):
            z = gates[t] + h @ u
            i, f, o = sigmoid(z[:, :n]), sigmoid(z[:, n : 2 * n]), sigmoid(z[:, 2 * n : 3 * n])
            g = np.tanh(z[:, 3 * n :])
            m = live[t][:, None]
            new = f * s + i * g
            tanh = np.tanh(new)
            if keep is not None:
                keep.append((t, h, s, i, f, o, g, tanh, m))
            s = np.where(m, new, s)
            h = np.where(m, o * tanh, h)
            out[t] = h
        return out

    def logits(self, x, live, keep=None):
        kept = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        both = np.concatenate([self._run(x, live, way, kept[way]) for way in "fb"], axis=2)
        if keep is not None:
            keep.update(kept, both=both)
        return both @ self.weights["o"][:-1] + self.weights["o"][-1]

    def gradients(self, x, live, y):
        keep: dict = {}
        z = self.logits(x, live, keep)
        n, grads = self.hidden, {}
        d = np.where(live, sigmoid(z) - y, 0).astype(np.float32) / max(live.sum(), 1)
        grads["o"] = np.append(np.einsum("tp,tph->h", d, keep["both"]), d.sum())
        back = d[:, :, None] * self.weights["o"][:-1]
        for k, way in enumerate("fb"):
            dout = back[:, :, k * n : (k + 1) * n]
            w, u = self.weights["x" + way], self.weights["h" + way]
            dz_all = np.zeros((x.shape[0], x.shape[1], 4 * n), np.float32)
            du = np.zeros_like(u)
            dh = ds = np.zeros((x.shape[1], n), np.float32)
            for t, h, s, i, f, o, g, tanh, m in reversed(keep[way]):
                total = dh + dout[t]
                inner = np.where(m, total, 0)
                dnew = np.where(m, ds, 0) + inner * o * (1 - tanh * tanh)
                dz = np.concatenate(
                    [dnew * g * i * (1 - i), dnew * s * f * (1 - f), inner * tanh * o * (1 - o), dnew * i * (1 - g * g)], axis=1
                )
                dz_all[t] = dz
                du += h.T @ dz
                dh = dz @ u.T + np.where(m, 0, total)
                ds = dnew * f + np.where(m, 0, ds)
            flat = dz_all.reshape(-1, 4 * n)
            grads["x" + way] = x.reshape(-1, INPUT).T @ flat
            grads["h" + way] = du
            grads["c" + way] = flat.sum(axis=0)
        return grads

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, rate: float = 6e-3, size: int = 32):
        """Adam over batches of pages of like length; (vectors, labels) each."""
        rng = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(w) for k, w in self.weights.items()}
        order = sorted(range(len(pages)), key=lambda k: len(pages[k][0]))
        batches = [order[k : k + size] for k in range(0, len(order), size)]
        step = 0
        for epoch in range(epochs):
            now = rate * (0.5 if epoch >= epochs - 3 else 1.0) * (0.3 if epoch == epochs - 1 else 1.0)
            for b in rng.permutation(len(batches)):
                x, live, y = padded([pages[k] for k in batches[b]])
                step += 1
                for name, g in self.gradients(x, live, y).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    self.weights[name] = (
                        self.weights[name] - now * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
                    ).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray], most: int = 40_000) -> list[np.ndarray]:
        """Chances of being article for the blocks of each page; pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            group = order[-max(1, most // longest) :]
            del order[-len(group) :]
            x, live, _ = padded([(pages[k], np.zeros(len(pages[k]))) for k in group])
            chance = sigmoid(self.logits(x, live))
            for p, k in enumerate(group):
                out[k] = chance[: len(pages[k]), p]
        return out


def padded(pages: list[tuple[np.ndarray, np.ndarray]]):
    length = max(len(x) for x, _ in pages)
    x = np.zeros((length, len(pages), INPUT), np.float32)
    live = np.zeros((length, len(pages)), bool)
    y = np.zeros((length, len(pages)), np.float32)
    for p, (rows, labels) in enumerate(pages):
        x[: len(rows), p], live[: len(rows), p], y[: len(rows), p] = rows, True, labels
    return x, live, y


def training_pages(sentences: list[str], many: int, seed: int = 0) -> list[tuple[str, list[Block], np.ndarray]]:
    """Set pages with the label of each of their blocks; a page whose blocks don't match what was set is left out."""
    setter, out = Setter(sentences, seed), []
    for _ in range(many):
        page, labels = setter.page()
        found = blocks(page)
        if len(found) == len(labels):
            out.append((page, found, np.array(labels, np.float32)))
    return out


def fit(pages: DataFrame, html: str = "html", sample: int = SAMPLE_PAGES, train: int = TRAIN_PAGES) -> Labeller:
    """A labeller trained on layouts set from the sentences of a bounded sample of the pages."""
    rows = max(pages.count(), 1)
    text = F.col(f"`{html}`").cast("string")
    mark = F.xxhash64(text)
    thin = pages.where(F.shiftrightunsigned(mark, 32) < int(min(1.0, 2 * sample / rows) * 2**32))
    picked = thin.select(mark.alias("mark"), F.substring(text, 1, SAMPLE_CHARS).alias("html")).distinct().orderBy("mark", "html")
    sentences = sorted({b.text for r in picked.limit(sample).collect() for b in blocks(r["html"])})
    sentences = [s for s in sentences if re.search(r"\w", s)] or ["lorem ipsum dolor sit amet"]
    made = training_pages(sentences, train)
    rows_of = vectors([found for _, found, _ in made])
    ends = np.cumsum([0, *(len(found) for _, found, _ in made)])
    return Labeller().train([(rows_of[a:b], y) for a, b, (_, _, y) in zip(ends, ends[1:], made, strict=False)])


def extract(
    pages: DataFrame, model: Labeller, html: str = "html", keep: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Kept columns (default all), `text`, the article's blocks by line, and n_chars, its code points."""
    # About 60,000 weights whatever the table.
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def make():
        def of(texts: pa.Array) -> list[pa.Array]:
            found = [blocks(t) for t in texts.to_pylist()]
            x = vectors(found)
            ends = np.cumsum([0, *map(len, found)])
            chances = sent.value.label([x[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
            main = ["\n".join(b.text for b, c in zip(f, p, strict=True) if c >= threshold) for f, p in zip(found, chances, strict=True)]
            return [pa.array(main), pa.array([len(t) for t in main], pa.int64())]

        return of

    return per_text(pages, make, "text string, n_chars long", html, keep, 1 << 20)
