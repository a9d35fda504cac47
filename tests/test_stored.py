"""Index and documents changed on disk: equal to a rebuild, and untouched files stay."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexiquarry.functions.hashing import shard_of
from lexiquarry.operators import documents, index, search, stored_documents, stored_index
from lexiquarry.plans.views import moment
from lexiquarry.sources import versions
from test_index import CORPUS, flat

def now():
    return moment("2024-02-01 00:00:00")


def files(root):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("gen=*/*.parquet")}


def words(rng):
    return " ".join(rng.choice("amber birch cedar delta ember frost grove heath".split()) for _ in range(rng.randint(0, 12)))


def test_many_replaced_keys_are_met_by_document(spark, docs, tmp_path, monkeypatch):
    """Postings are not joined with the keys; segments and a merge give what few keys give."""
    seen = []
    for most in (index.MANY_KEYS, 0):
        monkeypatch.setattr(index, "MANY_KEYS", most)
        root = str(tmp_path / str(most))
        stored_index.create_index(docs(**CORPUS, shards=3), root, buckets=4, doc_buckets=4)
        stored_index.upsert_index(spark, root, docs(a="red sea", e="green whale", shards=3))
        stored_index.upsert_index(spark, root, docs(e="green", f="song", shards=3))
        stored_index.delete_from_index(spark, root, docs(b="", unknown="", shards=3))
        late = stored_index.open_index(spark, root)
        read = late.postings.where("term = 'red'")._jdf.queryExecution().optimizedPlan().toString()
        assert ("term_bucket" in read.split("Join LeftAnti")[-1]) == (most > 0)
        found = flat(late)
        stored_index.merge_index(spark, root)
        merged = flat(stored_index.open_index(spark, root))
        assert merged == found
        seen.append(found)
    assert seen[0] == seen[1]


def test_upserts_and_deletes_equal_a_rebuild(spark, docs, tmp_path):
    rng, root = random.Random(4), str(tmp_path)
    now = {f"d{k}": words(rng) for k in range(40)}
    stored_index.create_index(docs(**now, shards=3), root, buckets=4, doc_buckets=4)
    for step in range(5):
        if step % 2:
            gone = rng.sample(sorted(now), 5)
            stored_index.delete_from_index(spark, root, docs(**dict.fromkeys([*gone, "unknown"], ""), shards=3))
            now = {k: t for k, t in now.items() if k not in gone}
        else:
            changed = {f"d{rng.randint(0, 60)}": words(rng) for _ in range(6)}
            stored_index.upsert_index(spark, root, docs(**changed, shards=3))
            now |= changed
        if step == 2:
            stored_index.merge_index(spark, root)
        found = stored_index.open_index(spark, root)
        assert flat(found) == flat(index.build_index(docs(**now, shards=3)))
        assert found.buckets == 4
    assert len(versions.read_version(spark, root).segments) == 2
    stored_index.merge_index(spark, root)
    assert versions.read_version(spark, root).segments == ()
    assert flat(stored_index.open_index(spark, root)) == flat(index.build_index(docs(**now, shards=3)))


def test_upsert_then_delete_is_the_original(spark, docs, tmp_path):
    root = str(tmp_path)
    before = flat(stored_index.create_index(docs(**CORPUS), root))
    stored_index.upsert_index(spark, root, docs(e="new blue"))
    stored_index.delete_from_index(spark, root, docs(e=""))
    assert flat(stored_index.open_index(spark, root)) == before
    stored_index.merge_index(spark, root)
    assert flat(stored_index.open_index(spark, root)) == before


def test_only_touched_files_are_rewritten(spark, docs, tmp_path):
    root = str(tmp_path)
    stored_index.create_index(docs(**{f"d{k}": f"alpha{chr(97 + k)} beta{chr(97 + k)}" for k in range(20)}, shards=3), root, buckets=16)
    before = files(root)
    stored_index.upsert_index(spark, root, docs(d3="alphad gamma", shards=3))
    assert files(root) == before
    old = versions.read_version(spark, root)
    new = stored_index.merge_index(spark, root)
    assert {f: t for f, t in files(root).items() if f in before} == before
    changed = {p for p in {**old.parts, **new.parts} if old.parts.get(p) != new.parts.get(p)}
    # One bucket of the id, and those of the words that came, went or stayed.
    assert sum(p[0] == "doc_terms" for p in changed) == 1
    assert sum(p[0] == "postings" for p in changed) <= 3
    assert len(new.parts) > 3 * len(changed)


def test_readers_of_an_old_version_keep_it_until_it_is_dropped(spark, docs, tmp_path):
    root = str(tmp_path)
    first = stored_index.create_index(docs(a="red", b="blue"), root, buckets=2)
    stored_index.upsert_index(spark, root, docs(a="green"))
    stored_index.merge_index(spark, root)
    assert flat(first) == flat(index.build_index(docs(a="red", b="blue")))
    assert flat(stored_index.open_index(spark, root, versions.read_version(spark, root, 1))) == flat(
        index.build_index(docs(a="green", b="blue"))
    )
    assert versions.drop_unused(spark, root, keep=1) > 0
    assert versions.versions(spark, root) == [2]
    assert flat(stored_index.open_index(spark, root)) == flat(index.build_index(docs(a="green", b="blue")))


def test_an_unpublished_segment_does_not_count(spark, docs, tmp_path):
    root = str(tmp_path)
    stored_index.create_index(docs(a="red"), root)
    _, folder = versions.new_segment(root)
    index.count_terms(index.analyze(docs(a="blue"))).write.parquet(f"{folder}/doc_terms")
    assert flat(stored_index.open_index(spark, root)) == flat(index.build_index(docs(a="red")))
    with pytest.raises(Exception, match="(?i)exist"):
        versions.publish(spark, root, versions.read_version(spark, root))


def test_search_opens_the_buckets_of_its_terms(spark, docs, tmp_path):
    root = str(tmp_path)
    frame = docs(**{f"d{k}": f"alpha{chr(97 + k)} common" for k in range(20)}, shards=2)
    stored_index.create_index(frame, root, buckets=8)
    stored_index.upsert_index(spark, root, docs(d3="alphab common", shards=2))
    now = stored_index.open_index(spark, root)
    scores = search.one_query_scores(now, search.query_weights(now, "alphab", "global", True), False)
    scan = scores._jdf.queryExecution().executedPlan().toString()
    assert "term_bucket" in scan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    plain = index.build_index(frame.where("doc_id <> 'd3'").unionByName(docs(d3="alphab common", shards=2)))
    hits = rows(search.search(now, frame, "alphab"), "doc_id", "rank", "score")
    assert hits == rows(search.search(plain, frame, "alphab"), "doc_id", "rank", "score")
    assert [h[0] for h in hits] == ["d1", "d3"]


def test_bytes_by_shard_are_those_of_the_files(spark, docs, tmp_path):
    root = str(tmp_path)
    stored_index.create_index(docs(**CORPUS, shards=3), root)
    stored_index.upsert_index(spark, root, docs(e="new", shards=3))
    found = {r["shard_id"]: r["index_size_bytes"] for r in stored_index.shard_bytes(spark, root).collect()}
    sizes = {}
    for p in pathlib.Path(root).rglob("*.parquet"):
        if p.is_file() and "/versions/" not in str(p):
            shard = str(p).split("shard_id=")[1].split("/")[0] if "shard_id=" in str(p) else None
            sizes[shard and int(shard)] = sizes.get(shard and int(shard), 0) + p.stat().st_size
    assert found == sizes and len(found) >= 2
    frame = docs(**CORPUS, shards=3)
    stats = index.index_stats(frame, stored_index.open_index(spark, root), stored_index.shard_bytes(spark, root))
    assert {r["shard_id"]: r["index_size_bytes"] for r in stats.collect()} == {s: n for s, n in sizes.items() if s is not None}


def batch(docs, *given):
    """(id, text, seq) as an incoming batch."""
    frame = docs(*((k, "t", t) for k, t, _ in given), shards=3).drop("created_at", "updated_at")
    numbers = frame.sparkSession.createDataFrame([(k, t, s) for k, t, s in given], "doc_id string, content string, seq bigint")
    return frame.join(numbers, ["doc_id", "content"])


def shown(frame):
    return rows(frame, "shard_id", "doc_id", "title", "content", "created_at", "updated_at")


def test_stored_documents_equal_the_frame_form(spark, docs, tmp_path):
    root, rng = str(tmp_path), random.Random(2)
    frame = docs(**{f"d{k}": f"text {k}" for k in range(30)}, shards=3)
    stored_documents.create_documents(frame, root)
    assert shown(stored_documents.open_documents(spark, root)) == shown(frame)
    for step in range(4):
        ids = rng.sample(range(40), 6)
        given = batch(docs, *((f"d{k}", f"text {k} {step}", step) for k in ids), (f"d{ids[0]}", "last", 99))
        expected = documents.upsert_documents(frame, given, now())
        status = stored_documents.upsert_documents(spark, root, given, now())
        changed = expected.where("status <> 'unchanged'")
        assert rows(status) == rows(changed, "shard_id", "doc_id", "status")
        frame = expected.drop("status")
        if step == 1:
            stored_documents.merge_documents(spark, root)
        if step == 2:
            ids = docs(d1="", d5="", nobody="", shards=3)
            result = stored_documents.delete_documents(spark, root, ids)
            assert rows(result) == rows(documents.delete_results(frame, ids))
            frame = documents.delete_documents(frame, ids)
        assert shown(stored_documents.open_documents(spark, root)) == shown(frame)
    stored_documents.merge_documents(spark, root)
    assert shown(stored_documents.open_documents(spark, root)) == shown(frame)


def test_a_batch_leaves_other_files_as_they_are(spark, docs, tmp_path):
    root = str(tmp_path)
    stored_documents.create_documents(docs(**{f"d{k}": "x" for k in range(60)}, shards=3), root)
    before = files(root)
    stored_documents.upsert_documents(spark, root, batch(docs, ("d7", "y", 1)), now())
    old = versions.read_version(spark, root)
    new = stored_documents.merge_documents(spark, root)
    assert {f: t for f, t in files(root).items() if f in before} == before
    assert sum(old.parts.get(p) != new.parts.get(p) for p in new.parts) == 1


def test_a_batch_reads_the_buckets_of_its_ids(spark, docs, tmp_path):
    root = str(tmp_path)
    stored_documents.create_documents(docs(**{f"d{k}": "x" for k in range(60)}, shards=3), root)
    version = versions.read_version(spark, root)
    keys = docs(d7="", shards=3).select("shard_id", "doc_id")
    opened = stored_documents._stored(spark, root, version, keys).inputFiles()
    own = keys.select("shard_id", F.expr("cast(pmod(xxhash64(doc_id), 16) as int)").alias("b")).first()
    parts = [f for f in opened if "/documents/" in f]
    assert parts and all(f"shard_id={own['shard_id']}/doc_bucket={own['b']}/" in f for f in parts)
    assert keys.select(shard_of("doc_id", 3)).first()[0] == own["shard_id"]


def test_empty_tables(spark, docs, tmp_path):
    root = str(tmp_path / "documents")
    empty = docs(a="x").where("false")
    assert stored_documents.create_documents(empty, root).count() == 0
    stored_documents.upsert_documents(spark, root, batch(docs, ("a", "x", 1)).where("false"), now())
    stored_documents.upsert_documents(spark, root, batch(docs, ("a", "x", 1)), now())
    assert stored_documents.merge_documents(spark, root).segments == ()
    assert [r["doc_id"] for r in stored_documents.open_documents(spark, root).collect()] == ["a"]
    root = str(tmp_path / "index")
    stored_index.create_index(empty, root)
    stored_index.upsert_index(spark, root, docs(a="red"))
    assert flat(stored_index.open_index(spark, root)) == flat(index.build_index(docs(a="red")))
    stored_index.delete_from_index(spark, root, docs(a=""))
    stored_index.merge_index(spark, root)
    assert flat(stored_index.open_index(spark, root)) == ([], [], [])


def test_whole_rows_are_met_with_replaced_or_wanted_keys_only(spark, docs, tmp_path, monkeypatch):
    """Of what segments replace only the few rows that stopped counting, not every key of a segment."""
    sides, look = [], versions.lookup_side

    def side(rows):
        sides.append(rows.count())
        return look(rows)

    monkeypatch.setattr(versions, "lookup_side", side)
    root = str(tmp_path)
    frame = docs(**{f"d{k}": f"text {k}" for k in range(20)}, shards=3)
    stored_index.create_index(frame.limit(0), root)
    stored_index.upsert_index(spark, root, frame)
    stored_index.upsert_index(spark, root, docs(d3="late", e="new", shards=3))
    assert sides[-1] == 1  # of the two keys one was stored
    version = versions.read_version(spark, root)
    sides.clear()
    gone = versions.replaced(spark, root, version)
    kept = stored_index._doc_terms(spark, root, version, gone)
    assert sides == [21, 1]
    assert rows(kept, "doc_id") == sorted((f"d{k}",) for k in range(20)) + [("e",)]
    assert [r["terms"][0]["term"] for r in kept.where("doc_id = 'd3'").collect()] == ["late"]


def test_a_merge_shuffles_one_shard_at_a_time(spark, docs, tmp_path, monkeypatch):
    written, write = [], versions.write_parts

    def parts(frame, root, table, bucket, order):
        written.append((table, frame.select("shard_id").distinct().count()))
        return write(frame, root, table, bucket, order)

    for root, most in ((str(tmp_path / "few"), index.MANY_KEYS), (str(tmp_path / "many"), 0)):
        monkeypatch.setattr(index, "MANY_KEYS", most)
        now = {f"d{k}": f"red {'x' * k}" for k in range(20)}
        stored_index.create_index(docs(**now, shards=3), root, buckets=2, doc_buckets=2)
        now |= {f"d{k}": f"blue {'y' * k}" for k in range(9)}
        stored_index.upsert_index(spark, root, docs(**now, shards=3))
        written.clear()
        with monkeypatch.context() as patch:
            patch.setattr(versions, "write_parts", parts)
            stored_index.merge_index(spark, root)
        assert [n for table, n in written if table != "term_stats"] == [1] * 6
        assert flat(stored_index.open_index(spark, root)) == flat(index.build_index(docs(**now, shards=3)))
