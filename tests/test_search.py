import math
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexiquarry.operators import index as index_ops
from lexiquarry.operators import search as ops
from lexiquarry.operators.ranking import top_rows

TWO = {"a": "red red blue", "b": "blue"}
MORE = {
    "a": "red red blue",
    "b": "blue whale",
    "c": "the",
    "d": "whale song, whale watching",
    "e": "red whale",
    "f": "green sea",
}


def hits(docs, contents, query, **options):
    frame = docs(**contents)
    found = ops.search(index_ops.build_index(frame), frame, query, **options)
    return [(r.doc_id, r.score) for r in found.collect()]


def brute_force(contents, query, stop=("the",)):
    words = {k: [w.strip(",") for w in v.split() if w not in stop] for k, v in contents.items()}
    df = Counter(w for ws in words.values() for w in set(ws))
    scores = {}
    for doc, ws in words.items():
        shared = [w for w in query.split() if w in ws]
        if shared:
            scores[doc] = round(sum(ws.count(w) / len(ws) * math.log(len(words) / df[w]) for w in shared), 6)
    return sorted(scores.items(), key=lambda item: (-item[1], item[0]))


def test_hand_computed_scores(docs):
    assert hits(docs, TWO, "red") == [("a", round(2 / 3 * math.log(2), 6))]
    assert hits(docs, TWO, "red") == [("a", 0.462098)]
    assert hits(docs, TWO, "red red") == [("a", 0.924196)]


def test_zero_scores_stay_in_id_order(docs):
    assert hits(docs, TWO, "blue") == [("a", 0.0), ("b", 0.0)]


@pytest.mark.parametrize("query", ["whale", "red whale", "blue sea green", "red red whale song"])
def test_against_brute_force(docs, query):
    assert hits(docs, MORE, query, stem=False) == brute_force(MORE, query)


def test_empty_query_and_stop_words(docs):
    with pytest.raises(ValueError, match="Query is required"):
        hits(docs, TWO, "")
    assert hits(docs, TWO, "the and") == []


def test_unknown_statistics_are_refused(docs):
    with pytest.raises(ValueError, match="stats"):
        hits(docs, TWO, "red", stats="some")


def test_pages_make_up_the_ranking(docs):
    whole = hits(docs, MORE, "red whale blue")
    pages = [hits(docs, MORE, "red whale blue", size=2, offset=n) for n in (0, 2, 4)]
    assert [hit for page in pages for hit in page] == whole


def test_one_shard_equals_global(docs):
    for query in ("whale", "red blue"):
        assert hits(docs, MORE, query, stats="shard") == hits(docs, MORE, query, stats="global")


def test_shards_score_with_their_own_statistics(docs):
    frame = docs(**MORE, shards=3)
    index = index_ops.build_index(frame)
    found = ops.search(index, frame, "red whale", stats="shard").collect()
    assert [r.score for r in found] == sorted((r.score for r in found), reverse=True)
    for shard in {r.shard_id for r in found}:
        part = frame.where(F.col("shard_id") == shard)
        alone = ops.search(index_ops.build_index(part), part, "red whale").collect()
        assert {(r.doc_id, r.score) for r in found if r.shard_id == shard} == {
            (r.doc_id, r.score) for r in alone
        }


def test_single_query_equals_batch_on_a_stored_index(spark, docs, tmp_path):
    frame = docs(**MORE, shards=3)
    index = index_ops.store_index(frame, str(tmp_path / "index"), buckets=2)
    queries = spark.createDataFrame([(1, "red whales"), (2, "the"), (3, "sea")], "query_id bigint, query string")
    batch = ops.search_batch(index, frame, queries)
    assert {r.query_id for r in batch.collect()} == {1, 3}
    for number, query in ((1, "red whales"), (3, "sea")):
        one = ops.search(index, frame, query)
        assert rows(one, "rank", "doc_id", "score") == rows(
            batch.where(F.col("query_id") == number), "rank", "doc_id", "score"
        )


def test_stored_postings_are_pruned_for_one_query(spark, docs, tmp_path):
    frame = docs(**MORE, shards=3)
    index = index_ops.store_index(frame, str(tmp_path / "index"), buckets=2)
    weights = ops.query_weights(index, "whale", "global", True)
    plan = ops.one_query_scores(index, weights, False)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,whale)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*term_bucket", plan)


def test_missing_documents_are_dropped(docs):
    index = index_ops.build_index(docs(**MORE))
    left = docs(**{k: v for k, v in MORE.items() if k != "d"})
    found = ops.search(index, left, "whale")
    assert [(r.rank, r.doc_id) for r in found.collect()] == [(1, "b"), (2, "e")]


def many(docs, n, shards=1):
    return docs(**{f"d{k:03d}": "whale " * (1 + k % 7) + "sea " * (k % 5) for k in range(n)}, shards=shards)


@pytest.mark.parametrize("stats", ["global", "shard"])
def test_pages_stay_full_when_the_best_are_gone(spark, docs, tmp_path, stats):
    frame = many(docs, 150, shards=3)
    index = index_ops.store_index(frame, str(tmp_path / "index"), buckets=2)
    queries = spark.createDataFrame([(1, "sea")], "query_id bigint, query string")
    best = [r.doc_id for r in ops.search(index, frame, "sea", size=70, stats=stats).collect()]
    left = frame.where(~F.col("doc_id").isin(best))
    expected = ops.search(index, frame, "sea", size=10, offset=70, stats=stats).collect()
    assert len(expected) == 10
    for hits in (ops.search(index, left, "sea", stats=stats), ops.search_batch(index, left, queries, stats=stats)):
        assert [(r.rank, r.doc_id) for r in hits.orderBy("rank").collect()] == [
            (r.rank - 70, r.doc_id) for r in expected
        ]


def test_deep_pages_of_shards(spark, docs, tmp_path):
    frame = many(docs, 150, shards=3)
    index = index_ops.store_index(frame, str(tmp_path / "index"), buckets=2)
    queries = spark.createDataFrame([(1, "whale")], "query_id bigint, query string")
    pages = [
        [r.doc_id for r in ops.search_batch(index, frame, queries, offset=n, stats="shard").orderBy("rank").collect()]
        for n in (60, 140, 150)
    ]
    whole = [r.doc_id for r in ops.search(index, frame, "whale", size=200, stats="shard").collect()]
    assert len(whole) == 150 and pages == [whole[60:70], whole[140:], []]


def test_a_query_of_very_many_terms(spark, docs):
    words = ["x" + a + b for a in "bcdfghklmn" for b in "bcdfghklmn"]
    contents = {"a": " ".join(words), "b": words[3], "c": "sea"}
    index = index_ops.build_index(docs(**contents), stem=False)
    found = ops.search(index, docs(**contents), " ".join(words), stem=False).collect()
    assert [r.doc_id for r in found] == ["b", "a"] or [r.doc_id for r in found] == ["a", "b"]
    assert {(r.doc_id, r.score) for r in found} == set(brute_force(contents, " ".join(words)))


def test_near_scores_keep_their_order(docs):
    """Scores that are equal to six places are told apart."""
    contents = {"a": "red " + "sea " * 60_000, "b": "red " + "sea " * 59_000, "c": "sea"}
    assert [d for d, _ in hits(docs, contents, "red", stem=False)] == ["b", "a"]


def test_no_exchange_carries_matches(spark, docs, tmp_path):
    frame = many(docs, 50)
    index = index_ops.store_index(frame, str(tmp_path / "index"), buckets=2)
    queries = spark.createDataFrame([(n, "whale sea") for n in range(5)], "query_id bigint, query string")
    weights = ops.term_weights(index, ops.query_terms(queries))
    best = ops.best_of_documents(index.doc_terms, weights, 10)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    # One exchange by query, of what the limit below it leaves; the sums above the scan need none.
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(query_id" in plan
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "HashAggregate" in below and "Generate" in below
    scored = ops.top_k(ops.tfidf(index, ops.query_terms(queries)), 10)
    assert rows(best, "query_id", "doc_id", "score") == rows(scored, "query_id", "doc_id", "score")


def test_scores_of_all_candidates_are_summed_by_document(spark, docs, tmp_path):
    index = index_ops.store_index(docs(**MORE), str(tmp_path / "index"), buckets=2)
    queries = spark.createDataFrame([(n, q) for n, q in enumerate(["red whale", "sea", "blue", "song"])], "query_id bigint, query string")
    terms = ops.query_terms(queries)
    for stats in ("global", "shard"):
        scores = ops.tfidf(index, terms, stats)
        assert "Exchange hashpartitioning" not in scores._jdf.queryExecution().executedPlan().toString()
        assert rows(scores) == rows(ops.tfidf(replace(index, doc_terms=None), terms, stats))
    met = ops.candidates(index, terms)
    assert "term_bucket" in met.columns
    assert rows(met) == rows(ops.candidates(replace(index, doc_terms=None), terms), *met.columns)
    ids = met.select("query_id", "shard_id", "doc_id").distinct()
    assert "Exchange hashpartitioning" not in ids._jdf.queryExecution().executedPlan().toString()


def test_weights_beyond_the_broadcast_bound(spark, docs, tmp_path):
    index = index_ops.store_index(docs(**MORE), str(tmp_path / "index"))
    queries = spark.createDataFrame([(n, q) for n, q in enumerate(["red whale", "sea", "blue", "song"])], "query_id bigint, query string")
    weights = ops.term_weights(index, ops.query_terms(queries))
    whole = rows(ops.best_of_documents(index.doc_terms, weights, 3), "query_id", "doc_id", "score")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(ops.best_of_documents(index.doc_terms, weights, 3), "query_id", "doc_id", "score") == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_the_page_of_one_query_collects_no_more_than_it_reaches(spark, docs, monkeypatch):
    """Whatever share of the best documents is gone."""
    frame = many(docs, 60)
    index = index_ops.build_index(frame)
    left = frame.where("doc_id in ('d50', 'd51', 'd52') or doc_id like '%9'")
    collected = []
    real = type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: collected.append(real(self)) or collected[-1])
    found = ops.search(index, left, "whale", size=2)
    assert max(len(r) for r in collected if r and "score" in r[0]) <= 2
    ranked = ops.search(index, frame, "whale", size=60).collect()
    there = {r["doc_id"] for r in left.collect()}
    assert [r["doc_id"] for r in found.collect()] == [r["doc_id"] for r in ranked if r["doc_id"] in there][:2]


def test_pages_open_the_buckets_of_their_hits(spark, docs, tmp_path):
    from lexiquarry.sources.tables import read_documents, write_documents

    write_documents(many(docs, 50), str(tmp_path / "docs"))
    stored = read_documents(spark, str(tmp_path / "docs"))
    index = index_ops.build_index(stored)
    found = ops.search(index, stored, "whale", size=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*doc_bucket", plan) and "In(doc_id" in plan
    assert len(found.collect()) == 2


def test_totals(docs, spark):
    index = index_ops.build_index(docs(**MORE))
    queries = spark.createDataFrame([(1, "whale"), (2, "sea")], "query_id bigint, query string")
    scores = ops.tfidf(index, ops.query_terms(queries))
    assert rows(ops.total_hits(scores)) == [(1, 3), (2, 1)]
    assert rows(ops.total_hits(scores, cap=2)) == [(1, 2), (2, 1)]


def test_joins_beyond_the_broadcast_bound_give_the_same(spark, docs):
    frame = docs(**MORE)
    index = index_ops.build_index(frame)
    queries = spark.createDataFrame([(1, "red whale"), (2, "blue")], "query_id bigint, query string")
    expected = rows(ops.search_batch(index, frame, queries), "query_id", "rank", "doc_id", "score")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(ops.search_batch(index, frame, queries), "query_id", "rank", "doc_id", "score") == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_hot_query_is_pruned_before_the_shuffle(spark):
    scores = spark.range(100).select(
        F.when(F.col("id") < 90, 1).otherwise(2).alias("query_id"),
        F.col("id").cast("string").alias("doc_id"),
        F.lit(0.5).alias("score"),
    )
    plan = ops.top_k(scores, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("k", [7, 1500])
def test_top_rows_of_a_hot_key(spark, k):
    frame = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("score"),
        F.col("id").cast("string").alias("name"),
    )
    got = top_rows(frame, ["key"], [F.desc("score"), F.asc("name")], k, salt="name")
    hot = sorted(((r.score, r.name) for r in frame.where("key = 0").collect()), key=lambda p: (-p[0], p[1]))
    found = got.where("key = 0").orderBy("rank").collect()
    assert [(r.score, r.name) for r in found] == hot[:k]
    assert got.where("key <> 0").count() == frame.where("key <> 0").count()
