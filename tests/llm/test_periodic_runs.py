"""Periodic runs against all pairs of starts and periods, and their digests."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiquarry.llm import periodic_runs, queries
from tests.llm.odd import CLASHES, docs, empty, odd

SPACES = re.compile("[^\x20\x09-\x0d]+")


def slow_runs(words, least=6, times=4):
    """Every maximal stretch of every period, the smallest period of each stretch."""
    found = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def slow_row(doc_id, text, alter=True):
    words = SPACES.findall(text or "")
    n = len(words)
    if alter and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(slow_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *best,
        best[1] and 1000 * best[1] // best[2],
        sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def random_words(rng):
    out = []
    for _ in range(rng.randint(1, 6)):
        kind = rng.random()
        some = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))]
        if kind < 0.5:
            out += (some * rng.randint(1, 9))[: rng.randint(1, 60)]
        elif kind < 0.8:
            out += [rng.choice("ab") for _ in range(rng.randint(1, 25))]
        else:
            out += some
    return out


def test_runs_of_many_small_texts_equal_all_pairs():
    rng = random.Random(5)
    texts = [random_words(rng) for _ in range(1500)] + [[]] + [["a"] * k for k in range(4, 12)]
    numbers = {}
    word = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t])
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    for least, times in ((6, 4), (1, 3), (10, 5)):
        expected = [
            (starts[k] + a, m, q) for k, t in enumerate(texts) for a, m, q in sorted(slow_runs(t, least, times), key=lambda r: (r[0], r[2]))
        ]
        assert [tuple(r) for r in periodic_runs.runs_of(word, text, least, times)] == expected
        assert len(expected) > 100


def test_smallest_periods_and_nested_runs():
    def runs(words):
        numbers = {}
        word = np.array([numbers.setdefault(w, len(numbers)) for w in words.split()])
        return [tuple(r) for r in periodic_runs.runs_of(word, np.zeros(len(word), np.int64))]

    assert runs("x a b a b a b a b y") == [(1, 8, 2)]
    assert runs("a a a a a") == []
    assert runs("a a a a a a") == [(0, 6, 1)]
    # Six of the same word inside a period of eight words.
    inner = "a a a a a a b c " * 4
    assert runs(inner) == [(0, 6, 1), (0, 32, 8), (8, 6, 1), (16, 6, 1), (24, 6, 1)]
    # Words at the seams belong to two runs.
    assert runs("a b a b a b a b c b c b c b c") == [(0, 8, 2), (7, 8, 2)]


def test_segments_are_split_until_stable():
    # b is frequent in the whole, but in no part that x leaves; then c falls, too.
    words = "a b c a b c x a b c a b c".split()
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    word = np.array([numbers[w] for w in words])
    begin, end = periodic_runs.split_segments(word, np.zeros(len(word), np.int64), 6, 4)
    assert len(begin) == 0


@pytest.mark.parametrize("text", ["a b " * 300_000, "a " * 600_000, " ".join(random.Random(1).choices("abcdefgh", k=300_000))])
def test_long_texts_take_no_quadratic_time(text):
    import time

    words = np.array([ord(w) for w in text.split()])
    start = time.perf_counter()
    found = periodic_runs.runs_of(words, np.zeros(len(words), np.int64))
    assert time.perf_counter() - start < 30
    if text.startswith("a "):
        assert len(found) == 1


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for k in range(400):
        text = " ".join(random_words(rng) if k % 2 else [rng.choice("uvwxyz") + str(rng.randint(0, 40)) for _ in range(120)])
        rows.append((k, text if k % 7 else text.replace(" ", "\t\n", 3) + "\v "))
    rows += [(None, "a b " * 9), (1000, None), (1001, ""), (1002, " \n "), (1003, "été　x " * 9), (5, "z " * 40)]
    rows += [(5, "z " * 40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    altered = [k for k, t in rows if k is not None and zlib.crc32(str(k).encode()) % 10 == 0]
    assert len(altered) > 20
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted((slow_row(*r) for r in rows), key=repr)


def test_odd_rows_and_clashing_columns(spark):
    frame = odd(spark).withColumns({"runs": F.lit("own"), "collapsed": F.lit("own"), "best": F.lit("own")})
    found = periodic_runs.find_runs(frame)
    assert found.count() == frame.count()
    assert {c: found.first()[c] for c in CLASHES} == {c: f"own {c}" for c in CLASHES}
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[2]["runs"] == [] and by_id[2]["collapsed"] == "" and by_id[4]["collapsed"] == ""
    (run,) = by_id[6]["runs"]
    assert tuple(run) == (0, 18 * 800, 18) and len(by_id[6]["collapsed"].split()) == 18
    assert periodic_runs.find_runs(empty(spark)).collect() == []
    assert periodic_runs.digest(periodic_runs.find_runs(empty(spark)), ["doc_id"]).collect() == []


def test_other_thresholds(spark):
    got = periodic_runs.find_runs(docs(spark, "a b c a b c a b c"), least=9, times=3).first()
    assert [tuple(r) for r in got["runs"]] == [(0, 9, 3)] and got["collapsed"] == "a b c"
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs(spark, "a"), times=2)
