from collections import Counter

from conftest import rows
from lexiquarry.operators import index as ops


def flat(index):
    return (
        rows(index.postings, "shard_id", "term", "doc_id", "tf"),
        rows(index.term_stats, "shard_id", "term", "df"),
        rows(index.doc_stats, "shard_id", "doc_id", "doc_len"),
    )


CORPUS = {
    "a": "red red blue",
    "b": "blue whale",
    "c": "The",
    "d": "running runs red, whale-like whale. " * 30,
}


def test_counts_of_a_small_corpus(docs):
    index = ops.build_index(docs(a="red red blue", b="blue", c="the"), stem=False)
    assert flat(index) == (
        [(0, "blue", "a", 1), (0, "blue", "b", 1), (0, "red", "a", 2)],
        [(0, "blue", 2), (0, "red", 1)],
        [(0, "a", 3), (0, "b", 1), (0, "c", 0)],
    )
    assert rows(ops.corpus_size(index.doc_stats)) == [(0, 3)]


def test_title_is_part_of_the_text(docs):
    index = ops.build_index(docs(("a", "Red", "blue"), ("b", None, "green")), stem=False)
    assert [r[1] for r in flat(index)[0]] == ["blue", "green", "red"]


def test_stems_of_one_document_are_counted_together(docs):
    index = ops.build_index(docs(d="running runs run"))
    assert flat(index)[0] == [(0, "run", "d", 3)]


def test_term_counts_equal_a_plain_count(docs):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i % 7)}" for i in range(5000)]
    index = ops.build_index(docs(big=" ".join(words)), stem=False)
    assert {r.term: r.tf for r in index.postings.collect()} == Counter(words)


def test_stored_index_equals_the_plan_and_a_second_build(docs, tmp_path):
    frame = docs(**CORPUS, shards=3)
    built = flat(ops.build_index(frame))
    assert flat(ops.store_index(frame, str(tmp_path / "one"), buckets=1)) == built
    assert flat(ops.store_index(frame, str(tmp_path / "two"), buckets=3)) == built
    again = ops.read_index(frame.sparkSession, str(tmp_path / "two"))
    assert flat(again) == built
    assert again.buckets == 3
    assert ops.index_bytes(frame.sparkSession, str(tmp_path / "one")).first()[0] > 0


def test_the_index_published_last_is_current(docs, tmp_path):
    first, second = docs(a="red"), docs(a="blue", b="sea")
    root = str(tmp_path / "index")
    ops.publish_index(first, root, buckets=2)
    old = ops.current_index(first.sparkSession, root)
    ops.publish_index(second, root, buckets=2)
    assert flat(ops.current_index(first.sparkSession, root)) == flat(ops.build_index(second))
    assert flat(old) == flat(ops.build_index(first))


def test_upsert_equals_rebuild(docs):
    before = ops.build_index(docs(**CORPUS))
    changed = docs(a="green", e="new blue")
    after = {**CORPUS, "a": "green", "e": "new blue"}
    assert flat(ops.index_upsert(before, changed)) == flat(ops.build_index(docs(**after)))


def test_upsert_then_delete_is_the_original(docs):
    before = ops.build_index(docs(**CORPUS))
    changed = docs(e="new blue")
    assert flat(ops.index_delete(ops.index_upsert(before, changed), changed)) == flat(before)


def test_delete_drops_terms_without_documents(docs):
    index = ops.index_delete(ops.build_index(docs(**CORPUS)), docs(b="", unknown=""))
    rest = {k: v for k, v in CORPUS.items() if k != "b"}
    assert flat(index) == flat(ops.build_index(docs(**rest)))


def test_files_by_document_grow_with_the_corpus(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(ops, "DOCS_PER_FILE", 2)
    frame = docs(**{f"d{k}": f"red whale {k}" for k in range(90)})
    stored = ops.store_index(frame, str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index" / "layout")).first()["doc_files"] == 45
    assert stored.doc_terms.groupBy(*ops.KEY).count().rdd.getNumPartitions() == 45
    assert flat(stored) == flat(ops.build_index(frame))
    again = ops.write_index(ops.build_index(docs(a="red")), str(tmp_path / "small"))
    assert again.doc_terms.groupBy(*ops.KEY).count().rdd.getNumPartitions() == ops.DOC_FILES


def test_all_tables_from_one_analysis(docs):
    index = ops.build_index(docs(**CORPUS), once=True)
    for table in (index.postings, index.term_stats, index.doc_stats):
        assert "regexp_extract_all" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert flat(index) == flat(ops.build_index(docs(**CORPUS)))


def test_many_changed_documents_are_met_by_document(docs, tmp_path, monkeypatch):
    index = ops.store_index(docs(**CORPUS), str(tmp_path / "index"))
    changed, gone = docs(a="red sea", e="green"), docs(b="", unknown="")
    few = flat(ops.index_upsert(index, changed)), flat(ops.index_delete(index, gone))
    monkeypatch.setattr(ops, "MANY_KEYS", 0)
    after, left = ops.index_upsert(index, changed), ops.index_delete(index, gone)
    assert (flat(after), flat(left)) == few
    for entries in (after.postings, left.postings):
        assert "term_bucket" not in entries._jdf.queryExecution().analyzed().toString()


def test_reindex_leaves_documents_no_longer_in_the_table(docs):
    before = ops.build_index(docs(**CORPUS))
    after = ops.reindex(docs(a="red"), before)
    assert flat(after) == flat(ops.build_index(docs(**{**CORPUS, "a": "red"})))


def test_stats_join_table_and_index(docs):
    index = ops.build_index(docs(**CORPUS), stem=False)
    assert rows(ops.index_stats(docs(a="x"), index)) == [(0, 1, 4, index.term_stats.count())]


def test_analysis_is_evaluated_once_without_a_shuffle(spark, docs):
    frame = docs(**CORPUS).repartition(8)
    plan = ops.build_index(frame).postings._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    physical = ops.build_index(frame).postings._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange") == 1  # the repartition of the fixture
