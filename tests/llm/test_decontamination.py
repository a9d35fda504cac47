import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from llm.odd import CLASHES, SENTENCE, docs, empty, odd
from lexiquarry.llm import decontamination as ops
from lexiquarry.llm.fmindex import FMIndex, WaveletMatrix, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=13):
    """(n_words, n_hit, items) of each text, by looking each window up."""
    known = {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            known.setdefault(tuple(w[k : k + window]), set()).add(name)
    out = []
    for text in texts:
        w, hit, met = words(text), set(), set()
        for size in {len(k) for k in known}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in known:
                    hit.update(range(k, k + size))
                    met |= known[tuple(w[k : k + size])]
        out.append((len(w), len(hit), sorted(x for x in met if x is not None)))
    return out


def test_suffix_order_and_ranks():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 60, 400):
        symbols = np.append(rng.integers(0, 4, size), 0)
        order = suffix_array(symbols)
        # Separators are unlike each other, the earlier ones smaller.
        marked = [(0, k) if s == 0 else (1, int(s)) for k, s in enumerate(symbols)]
        assert order.tolist() == sorted(range(len(symbols)), key=lambda k: marked[k:])
        matrix = WaveletMatrix(symbols, 4)
        at = np.arange(len(symbols))
        symbol, before = matrix.access(at)
        assert symbol.tolist() == symbols.tolist()
        assert before.tolist() == [int((symbols[:k] == symbols[k]).sum()) for k in at]
        for s in range(4):
            assert matrix.rank(np.full(len(at), s), at).tolist() == [int((symbols[:k] == s).sum()) for k in at]


@pytest.mark.parametrize("every", [1, 3, 8])
def test_phrases_are_found_where_they_are(every):
    rng = np.random.default_rng(2)
    symbols = np.append(rng.integers(0, 3, 500), 0)
    index = FMIndex(symbols, 3, every)
    phrases = np.zeros((40, 6), np.int64)
    lengths = rng.integers(1, 7, 40)
    for row, size in zip(phrases, lengths, strict=True):
        row[6 - size :] = rng.integers(1, 3, size)
    low, high = index.search(phrases, lengths)
    for row, size, a, b in zip(phrases, lengths, low, high, strict=True):
        phrase = row[6 - size :].tolist()
        expected = [k for k in range(len(symbols) - size + 1) if symbols[k : k + size].tolist() == phrase]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


@pytest.mark.parametrize("blocks", [1, 3])
def test_against_brute_force(spark, blocks):
    rng = random.Random(4)
    vocabulary = ["a", "Bb", "é", "7", "sea", "Sea", "red-blue"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 80))) for _ in range(60)] + [None, ""]
    items = [(str(k), " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 6, 15])))) for k in range(14)]
    items += [items[3], ("n", None), ("e", " . "), (None, "sea sea red")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    size = max(len(t or "") for _, t in items) if blocks > 1 else 1 << 20
    got = ops.decontaminate(docs(spark, *texts), bench, keep=["doc_id"], window=4, shard_bytes=600, block_bytes=size)
    found = [(r.n_words, r.n_hit, r["items"]) for r in got.orderBy("doc_id").collect()]
    assert found == brute(texts, items, 4)


def test_spans_are_code_points_of_the_hits(spark):
    text = "Ébène! " + SENTENCE + " Fin, ébène."
    bench = spark.createDataFrame([(1, SENTENCE)], "item_id bigint, text string")
    row = ops.decontaminate(docs(spark, text), bench).first()
    assert [text[s.first : s["last"]] for s in row.spans] == [SENTENCE.rstrip(".")]
    assert "text" in row.asDict()


def test_verdict(spark):
    bench = spark.createDataFrame([(1, SENTENCE), (2, "of"), (10, "of the")], "item_id bigint, text string")
    frame = docs(spark, SENTENCE, "sea " * 400 + SENTENCE, "of the sea", None)
    got = {r.doc_id: r for r in ops.digest(ops.decontaminate(frame, bench)).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].contaminated) == (18, 18, True)
    assert (got[2].n_hit, got[2].contaminated) == (18, False)
    assert (got[3].n_items, got[3].items_sha256) == (2, hashlib.sha256(b"10,2").hexdigest())
    assert (got[4].n_words, got[4].n_items, got[4].contaminated) == (0, 0, False)


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, SENTENCE)], "item_id bigint, text string")
    found = ops.decontaminate(odd(spark), bench)
    rows = found.collect()
    assert len(rows) == 13 and sum(r.n_hit > 0 for r in rows) == 5
    assert set(CLASHES) - set(found.columns) == set() and len(found.columns) == len(set(found.columns))
    assert ops.decontaminate(empty(spark), bench).count() == 0
    none = ops.decontaminate(odd(spark), bench.where("false")).collect()
    assert len(none) == 13 and not any(r.n_hit for r in none)


def test_words_do_not_run_over_texts():
    found, hit, _ = ops.hits_in(pa.array(["red", "blue", None, "red blue"]), ops.phrases([("1", "red blue")]))
    assert hit.tolist() == [False, False, True, True]
