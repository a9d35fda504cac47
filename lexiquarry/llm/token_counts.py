"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut into pre-tokens (its spaces, then what follows up to the next
space; no piece of the vocabulary crosses such a cut), and a pre-token further
wherever no piece holds the two characters side by side. Distinct pre-tokens of
a batch lie one after another in one numpy array of piece ids. In each round
every sequence finds the lowest rank among its neighbouring pairs and merges
the pairs of that rank, all sequences at once, until none has a pair left. What
counts is the symbols that survive; a character outside the vocabulary counts
as many tokens as it has bytes.

Of several pairs with the lowest rank the left ones go first. They merge in one
round unless a merge would bring up a pair of still lower rank, which then has
precedence: the round stops there for that sequence.

Counts of pre-tokens are remembered in each Python worker, for as many as
`KEPT`; then the memory is emptied. That changes no count.

Defined cases: null or empty text has no tokens; repeated rows each get theirs;
very long texts and pre-tokens are whole.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexiquarry.llm.rows import per_text

SPACE = "▁"
LIMIT = 4096
KEPT = 1_000_000
NONE = np.int64(1) << 40
END = "\0 end"  # marks a run of spaces that ends a text; it cannot be part of a pre-token, which has no space inside


class Merges:
    """Pairs of piece ids, the piece each makes and its rank, from a sentencepiece BPE model."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = i
        self.char = {p: i for p, i in pieces.items() if len(p) == 1}
        self.beside = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        score = np.zeros(model.get_piece_size())
        keys, made = [], []
        for p, i in pieces.items():
            score[i] = model.get_score(i)
            for k in range(1, len(p)):
                left, right = pieces.get(p[:k]), pieces.get(p[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.made = np.append(np.array(made, np.int64)[order], -1)
        # Higher scores first; equal scores are equal ranks.
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NONE where it makes no piece."""
        key = left << 32 | right
        key[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, key)
        found = self.keys[at] == key
        made = np.where(found, self.made[at], -1)
        return np.where(found, self.rank[made], NONE), made

    def surviving(self, symbols: np.ndarray, owner: np.ndarray, sequences: int) -> np.ndarray:
        """Symbols left in each sequence; -1 - k stands for a character that counts k and merges with nothing."""
        total = np.zeros(sequences, np.int64)
        if not len(symbols):
            return total
        # rank and made belong to the pair of a symbol and its right neighbour.
        rank, made = self.right_pairs(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            edge = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            size = np.diff(np.append(edge, len(owner)))
            least = np.repeat(np.minimum.reduceat(rank, edge), size)
            # Sequences without a pair are done.
            over = least == NONE
            if over.any():
                total += np.bincount(owner[over], np.maximum(1, -1 - symbols[over]), sequences).astype(np.int64)
                live = ~over
                symbols, owner, rank, made, least = (x[live] for x in (symbols, owner, rank, made, least))
                if not len(symbols):
                    break
            chosen = self._chosen(rank == least, symbols, owner, made, least)
            symbols[chosen] = made[chosen]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            symbols, owner, rank, made = (x[keep] for x in (symbols, owner, rank, made))
            # Only pairs that touch a new symbol have changed.
            new = chosen - np.arange(len(chosen))
            touched = np.zeros(len(symbols), bool)
            touched[new] = True
            touched[np.maximum(new - 1, 0)] = True
            at = np.flatnonzero(touched)
            rank[at], made[at] = self.right_pairs(symbols, owner, at)
        return total

    def right_pairs(self, symbols, owner, at) -> tuple[np.ndarray, np.ndarray]:
        right = np.minimum(at + 1, len(symbols) - 1)
        rank, made = self.pairs(symbols[at], symbols[right])
        alone = (owner[at] != owner[right]) | (right == at)
        rank[alone] = NONE
        return rank, made

    def _chosen(self, best, symbols, owner, made, least) -> np.ndarray:
        """Places whose pair merges in this round: left to right without overlap, up to a merge that calls a better pair up."""
        at = np.flatnonzero(best)
        # Of a run of overlapping pairs every other one.
        run = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1)))
        nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[nth % 2 == 0]
        if (owner[at][1:] != owner[at][:-1]).all():
            return at
        piece = made[at]
        # The left neighbour is what a merge right before has made, or the symbol there.
        left = at - 1
        near = np.concatenate(([False], at[:-1] + 2 == at[1:]))
        before = np.where(near, np.concatenate(([-1], piece[:-1])), symbols[np.maximum(left, 0)])
        same = (left >= 0) & (owner[np.maximum(left, 0)] == owner[at])
        up_left = np.where(same, self.pairs(before, piece.copy())[0], NONE)
        right = np.minimum(at + 2, len(symbols) - 1)
        same = (at + 2 < len(symbols)) & (owner[right] == owner[at])
        up_right = np.where(same, self.pairs(piece.copy(), symbols[right])[0], NONE)
        stop = np.minimum(up_left, up_right) < least[at]
        # All up to the first that stops, in each sequence.
        stops = np.cumsum(stop) - stop
        head = np.concatenate(([True], owner[at][1:] != owner[at][:-1]))
        base = stops[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        return at[stops == base]


class Counter:
    """Token counts of texts, with a memory of pre-tokens."""

    def __init__(self, model_file: str, kept: int = KEPT):
        self.merges = Merges(model_file)
        self.known: dict[str, int] = {}
        self.kept = kept

    def count(self, texts: list[str | None]) -> np.ndarray:
        split = [self.pre_tokens(t) for t in texts]
        if len(self.known) > self.kept:
            self.known = {}
        new = [*{w for words in split for w in words if w not in self.known}]
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            self.known.update(zip(part, self.measure(part), strict=True))
        of = self.known.__getitem__
        return np.array([sum(map(of, words)) for words in split], np.int64)

    def pre_tokens(self, text: str | None) -> list[str]:
        """Cuts before each run of spaces; one space is put before the text."""
        if not text:
            return []
        words = (" " + text).replace(SPACE, " ").split(" ")
        # An empty part stands for one more space of the run that goes on.
        if "" not in words[1:]:
            return words[1:]
        out, spaces = [], 0
        for word in words[1:]:
            if word:
                out.append(" " * spaces + word if spaces else word)
                spaces = 0
            else:
                spaces += 1
        if spaces:
            out.append(" " * (spaces - 1) + END)
        return out

    def measure(self, words: list[str]) -> list[int]:
        """Counts of pre-tokens; each begins with one space that is not written."""
        char, beside = self.merges.char, self.merges.beside
        chars = "".join(
            SPACE * (len(w) - len(END) + 1) if w.endswith(END) else SPACE + w.replace(" ", SPACE) for w in words
        )
        # Places where a sequence begins: pre-tokens, and characters no piece holds side by side.
        begins = np.zeros(len(chars) + 1, bool)
        sizes = [len(w) - len(END) + 1 if w.endswith(END) else len(w) + 1 for w in words]
        begins[np.concatenate(([0], np.cumsum(sizes)))] = True
        points = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        pair = points[:-1] << 21 | points[1:]
        distinct, which = np.unique(pair, return_inverse=True)
        apart = np.array([chr(p >> 21) + chr(p & 0x1FFFFF) not in beside for p in distinct.tolist()], bool)
        begins[1:-1] |= apart[which]
        distinct, which = np.unique(points, return_inverse=True)
        ids = [char.get(c, -1 - len(c.encode("utf-8", "surrogatepass"))) for c in map(chr, distinct.tolist())]
        owner = np.cumsum(begins[:-1]) - 1
        left = self.merges.surviving(np.array(ids, np.int64)[which], owner, int(owner[-1]) + 1)
        word = np.repeat(np.arange(len(words)), sizes)[begins[:-1]]
        return np.bincount(word, left, len(words)).astype(np.int64).tolist()


@functools.lru_cache(maxsize=2)
def counter(model_file: str) -> Counter:
    """One for each Python worker, which serves many tasks."""
    return Counter(model_file)


def count_tokens(
    docs: DataFrame, model_file: str, limit: int = LIMIT, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Kept columns (default all), n_bytes, n_tokens and over_limit; the vocabulary file is read on the executors."""

    def make():
        count = counter(model_file).count

        def of(texts: pa.Array) -> list[pa.Array]:
            rows = texts.to_pylist()
            tokens = count(rows)
            size = [len(t.encode()) if t else 0 for t in rows]
            return [pa.array(size, pa.int64()), pa.array(tokens), pa.array(tokens > limit)]

        return of

    return per_text(docs, make, "n_bytes long, n_tokens long, over_limit boolean", text, keep, 2 << 20)
