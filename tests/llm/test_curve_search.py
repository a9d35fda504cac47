"""Neighbours on Hilbert curves against all pairs."""

import itertools
import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiquarry.llm import curve_search, queries, sql
from lexiquarry.llm.hilbert import hilbert_keys

SCHEMA = "vec_id bigint, embedding array<float>"


def all_pairs(rows, k, every):
    """(query, place in the list) -> (id, score), ties to the smaller id; each row by its place in `rows`."""
    good = [
        (i, v)
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    sizes = [len(v) for _, v in good]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s)) if good else 0
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in good if len(v) == size]
    out = []
    for at, (i, v) in enumerate(good):
        if i % every == 0:
            scored = [(-float(np.cumsum(v * w)[-1]), j) for other, (j, w) in enumerate(good) if other != at]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def got(spark, rows, k=5, every=4, **settings):
    frame = spark.createDataFrame(rows, SCHEMA)
    found = curve_search.search(frame, F.col("vec_id") % every == 0, k=k, **settings)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (5, 2), (8, 1)])
def test_curve_steps_to_a_neighbouring_cell(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(keys)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_vectors_without_structure(spark):
    vectors = np.random.default_rng(1).normal(size=(300, 12))
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    # Small blocks, so that several orderings are asked.
    assert got(spark, rows, block=40) == all_pairs(rows, 5, 4)


def test_groups_of_vectors_need_few_windows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = [(k, (centres[k % 40] + 0.01 * rng.normal(size=16)).tolist()) for k in range(1600)]
    asked = []
    real = curve_search._asked
    monkeypatch.setattr(curve_search, "_asked", lambda p, total, reach, most: asked.append((reach, total)) or real(p, total, reach, most))
    found, expected = got(spark, rows, k=5, every=20, block=32), all_pairs(rows, 5, 20)
    assert len(found) == len(expected)
    assert len({r[::2] for r in found} & {r[::2] for r in expected}) >= 0.9 * len(expected)
    assert asked[0] == (1, asked[0][1]) and asked[0][1] >= 50


def test_lists_that_nothing_changes_ask_no_more(spark, monkeypatch):
    rows = [(k, [math.cos(k / 100), math.sin(k / 100)]) for k in range(600)]
    left = []
    real = curve_search._placed
    monkeypatch.setattr(curve_search, "_placed", lambda p, *a: left.append(p.where("query").count()) or real(p, *a))
    found, expected = got(spark, rows, k=3, every=10, block=16), all_pairs(rows, 3, 10)
    assert len(found) == len(expected)
    assert len(set(found) & set(expected)) >= 0.9 * len(expected)
    assert left[0] == 60 and left[-1] < 30


def test_unlike_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (v * 10 ** rng.uniform(-2, 2)).tolist()) for k, v in enumerate(rng.normal(size=(200, 6)))]
    assert got(spark, rows, block=40) == all_pairs(rows, 5, 4)


def test_equal_vectors_ties_and_repeated_rows(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(k, one) for k in range(40)] + [(k, two) for k in range(40, 50)]
    rows += [(8, one), (8, one), (12, two), (60, [-1.0, 0.0, 0.5]), (61, [0.0, 0.0, -0.0]), (64, [0.0, -0.0, 2.0])]
    assert got(spark, rows, block=8) == all_pairs(rows, 5, 4)
    # As many as there are, if fewer.
    assert got(spark, rows[:3], k=5, every=1) == all_pairs(rows[:3], 5, 1)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (4, [2.0, 1.0]), (5, [nan, 1.0]), (8, [inf, 1.0]), (12, None), (16, []), (20, [0.0, 0.0])]
    rows += [(24, [None, 1.0]), (None, [1.0, 1.0]), (28, [1.0]), (32, [1.0, 2.0, 3.0]), (3, [-1.0, 5.0]), (36, [1e30, -1e30])]
    assert got(spark, rows) == all_pairs(rows, 5, 4)
    assert got(spark, [], k=5) == []
    assert got(spark, [(4, [1.0, 2.0])]) == []
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = frame.withColumns({c: F.lit("own") for c in ("id", "h1", "h2", "ids", "query", "at", "part", "score", "rank")})
    found = curve_search.search(clashing, F.col("vec_id") % 4 == 0, k=5)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == all_pairs(rows, 5, 4)


def test_best_of_a_block_keeps_ties_by_first_id():
    rows = pa.table({"h1": range(6), "h2": range(6), "vector": [[1.0, 0.0]] * 6, "ids": [[9], [3], [7], [1], [5], [2]]})
    asked = pa.table({"q1": [1], "q2": [1], "asked": [[0.5, 0.5]]})
    assert curve_search.best_of(rows, asked, 3)["ids"].to_pylist() == [[1], [2], [3]]


def test_query_equals_sql(spark, tmp_path):
    vectors = np.random.default_rng(5).normal(size=(260, 64)).astype(np.float32)
    rows = [(k, (v / np.linalg.norm(v)).tolist()) for k, v in enumerate(vectors)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    expected = duckdb.sql(sql.OP12.replace("FROM embeddings", f"FROM '{tmp_path}/embeddings.parquet/*.parquet'")).fetchall()
    found = [tuple(r) for r in queries.op12_curve_search(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(expected) and len(found) == 13 * 20
