import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm.odd import docs, empty, odd
from lexiquarry.llm import packing, token_counts

tokenizers = pytest.importorskip("public_tokenizers")

ODD_TEXTS = [
    "", " ", "  ", " a", "a ", "a  ", "  a  b   ", "a\nb\t c\n\n", "<s> hi </s>", "a▁b ▁", "ﬁ ½ é é", "\x00x\x00 end",
    "日本 한글 𝒳 😀😀", "a" * 23, "ab" * 9, "0123456789 12", "\r\n\r\n", "=====-----____     ====", "x" * 3000,
    "ab" * 1500 + "  " * 40, " " * 70 + "\n" + " " * 33, "It's they'LL <|endoftext|> <|ENDOFTEXT|> !'s 'tis", "ǅ İ ΑΣ x\x1cy",
]


def random_texts(n):
    rng = random.Random(1)
    letters = ["".join(rng.choice("ab th eín ▁.,0\n") for _ in range(rng.randint(1, 60))) for _ in range(n)]
    parts = [" ", "  ", "ing", "tion", "ent", "er", "re", "s", "=="]
    return letters + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_counts_are_those_of_the_library():
    import sentencepiece

    file = tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    texts = ODD_TEXTS + random_texts(1500)
    expected = [len(x) for x in library.encode(texts, num_threads=1)]
    assert token_counts.Counter(file).count([*texts, None]).tolist() == [*expected, 0]
    assert token_counts.Counter(file, kept=3).count(texts).tolist() == expected


def test_count_rows(spark):
    import sentencepiece

    file = tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    got = token_counts.count_tokens(odd(spark), file).collect()
    assert len(got) == 13
    for r in got:
        expected = len(library.encode(r.text or ""))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (expected, len((r.text or "").encode()), expected > 4096)
    assert token_counts.count_tokens(empty(spark), file).count() == 0


def test_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    file = tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    texts = ODD_TEXTS + random_texts(300)
    ids, begin = packing.Encoder(file, kept=50).texts(pa.array([*texts, None]))
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[begin[k] : begin[k + 1]].tolist() == e.ids, texts[k]
    assert begin[-1] == begin[-2]


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_the_demand(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, 60, 32) * (rng.random(32) < 0.7)
    held, used = np.zeros(32, np.int64), 0
    for pattern, times in packing.cutting_stock(demand):
        assert (pattern * np.arange(1, 33)).sum() <= 32 and times > 0
        held += pattern * times
        used += times
    assert held.tolist() == demand.tolist()
    # First fit by descending size, one piece after the other.
    free = []
    for size in np.repeat(np.arange(32, 0, -1), demand[::-1]):
        at = next((k for k, room in enumerate(free) if room >= size), len(free))
        free[at:] = [free[at] - size, *free[at + 1 :]] if at < len(free) else [32 - size]
    assert used <= len(free) + 2


def test_knapsack_is_best():
    rng = np.random.default_rng(3)
    values = rng.random(9)
    best, pattern = packing.knapsack(values, 9)
    table = [0.0] * 10
    for size in range(1, 10):
        table[size] = max(table[size - 1], max(values[i - 1] + table[size - i] for i in range(1, size + 1)))
    assert best == pytest.approx(table[9])
    assert (pattern * values).sum() == pytest.approx(best) and (pattern * np.arange(1, 10)).sum() <= 9


def check_pieces(rows, texts, capacity):
    """Each id lies in exactly one piece; sequences have no gap and hold at most their capacity."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packed_texts_come_whole(spark):
    rng = random.Random(2)
    texts = {k: " ".join(rng.choices(["sea", "whale", "red", "x1"], k=rng.choice([0, 1, 5, 40, 200]))) for k in range(1, 120)}
    pieces = packing.token_pieces(docs(spark, *texts.values()), tokenizers.path("word_bpe_49k.json"), capacity=64)
    rows = packing.pack(pieces, capacity=64, bucket_rows=20).collect()
    sequences = check_pieces(rows, texts, 64)
    assert sum(r.length for r in rows) >= 0.9 * 64 * (len(sequences) - 1)


def test_packing_odd_rows(spark):
    file = tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(odd(spark), file)
    rows = packing.pack(pieces).collect()
    assert sum(r.length for r in rows if r.doc_id == 7) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 7)
    assert [r.length for r in rows if r.doc_id == 2] == [1]
    none = packing.pack(packing.token_pieces(empty(spark), file))
    assert none.count() == 0 and none.columns[-2:] == ["sequence_id", "offset"]
