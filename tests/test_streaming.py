import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexiquarry import session
from lexiquarry.operators import documents as table
from lexiquarry.operators import index as index_ops
from lexiquarry.operators import search, stored_documents, stored_terms
from lexiquarry.operators import terms as term_ops
from lexiquarry.operators.ingest import accept
from lexiquarry.plans import streams
from lexiquarry.plans.views import moment
from lexiquarry.sources import messages, versions
from lexiquarry.streaming import index as index_streams
from lexiquarry.streaming import ingest as ingest_streams
from lexiquarry.streaming import log
from lexiquarry.streaming import terms as term_streams

NOW = "2024-06-01 00:00:00"


@pytest.fixture
def feed(spark, tmp_path):
    """Writes frames one after the other and streams them one file per micro-batch."""

    def make(name, *frames):
        path = str(tmp_path / name)
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(path)
        reader = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(path)

    return make


def finish(query):
    try:
        assert query.awaitTermination(240)
    finally:
        query.stop()


def seq(df, n):
    return df.withColumn("seq", F.lit(n).cast("bigint"))


def flat(index):
    return (
        rows(index.postings, "shard_id", "term", "doc_id", "tf"),
        rows(index.term_stats, "shard_id", "term", "df"),
        rows(index.doc_stats, "shard_id", "doc_id", "doc_len"),
    )


def test_ingest_equals_batch(spark, docs, feed, tmp_path):
    raw = [docs(a="one two").drop("shard_id"), docs(b="", c=None).drop("shard_id")]
    out = str(tmp_path / "out")
    finish(ingest_streams.start_ingest(feed("raw", *raw), F.lit("now"), out, str(tmp_path / "offsets"), folder=out))
    batch = accept(raw[0].unionByName(raw[1]), "now")
    rejected = log.read_log(spark, f"{out}/rejected")
    assert rows(rejected, "doc_id", "error") == rows(batch.where("not valid"), "doc_id", "error")
    sent = spark.read.schema(messages.MESSAGE).option("recursiveFileLookup", "true")
    accepted = sent.json(f"{out}/{messages.DOCUMENT_TOPIC}")
    assert accepted.select(F.get_json_object("value", "$.id")).first()[0] == "a"


def test_index_stream_equals_batch_upserts(spark, docs, feed, tmp_path):
    batches = [
        seq(docs(a="red red", b="blue"), 0),
        seq(docs(a="green"), 1).unionByName(seq(docs(a="red sea", c="new"), 2)),
        seq(docs(b="whale"), 0),
    ]
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    now = moment(NOW)
    finish(index_streams.index_stream(feed("docs", *batches), out, offsets, now))
    state = docs().where("false")
    for batch in batches:
        state = table.upsert_documents(state, batch, now).drop("status")
    got = index_streams.current_documents(spark, out)
    columns = ("doc_id", "content", "created_at", "updated_at")
    assert rows(got, *columns) == rows(state, *columns)
    assert rows(got, "doc_id", "status") == [("a", "updated"), ("b", "updated"), ("c", "indexed")]
    index = index_streams.current_index(spark, out)
    assert flat(index) == flat(index_ops.build_index(state))
    fresh = str(tmp_path / "fresh")
    index_streams.compact(spark, out, fresh)
    late, more = moment("2024-07-01 00:00:00"), seq(docs(a="late"), 0)
    finish(index_streams.index_stream(feed("more", more), fresh, str(tmp_path / "again"), late))
    state = table.upsert_documents(state, more, late).drop("status")
    assert rows(index_streams.current_documents(spark, fresh), *columns) == rows(state, *columns)
    assert flat(index_streams.current_index(spark, fresh)) == flat(index_ops.build_index(state))


def test_a_replayed_batch_changes_nothing(spark, docs, tmp_path):
    path = str(tmp_path / "log")
    frame = docs(a="x").select("doc_id", "content")
    log.start_log(spark, path, frame.schema)
    log.append(frame, path, 0)
    log.append(docs(a="y", b="z").select("doc_id", "content"), path, 1)
    log.append(docs(a="y", b="z").select("doc_id", "content"), path, 1)
    assert rows(log.latest(log.read_log(spark, path), ["doc_id"])) == [("a", "y"), ("b", "z")]
    fresh = str(tmp_path / "fresh")
    log.compact(spark, path, ["doc_id"], fresh)
    assert rows(log.read_log(spark, fresh)) == [("a", "y", -1), ("b", "z", -1)]


def test_a_stopped_stream_goes_on_where_it_was(spark, docs, feed, tmp_path):
    out, offsets, now = str(tmp_path / "out"), str(tmp_path / "offsets"), moment(NOW)
    finish(index_streams.index_stream(feed("docs", seq(docs(a="red"), 0)), out, offsets, now))
    stream = feed("docs", seq(docs(a="blue", b="sea"), 0))
    finish(index_streams.index_stream(stream, out, offsets, now))
    got = index_streams.current_documents(spark, out)
    assert rows(got, "doc_id", "content") == [("a", "blue"), ("b", "sea")]


def test_running_counts_equal_batch(spark, docs, feed, tmp_path):
    parts = [docs(a="red red blue"), docs(b="red sea"), docs(c="")]
    out = str(tmp_path / "out")
    counts = term_streams.term_count_stream(feed("docs", *parts))
    finish(term_streams.start_counts(counts, out, str(tmp_path / "offsets")))
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = term_streams.current_frequencies(spark, out)
    assert rows(got, "shard_id", "term", "frequency") == rows(term_ops.term_counts(whole))


def frequencies(spark, *items, name="frequency"):
    return spark.createDataFrame([(0, t, f) for t, f in items], f"shard_id int, term string, {name} bigint")


def test_sync_equals_batch(spark, feed, tmp_path):
    stored = frequencies(spark, ("a", 5), ("b", 5), ("c", 5))
    first, second = frequencies(spark, ("a", 2), ("b", 0)), frequencies(spark, ("b", 3), ("a", 0))
    out = str(tmp_path / "out")
    term_streams.seed_frequencies(stored, out)
    finish(term_streams.sync_stream(feed("counters", first, second), out, str(tmp_path / "offsets"), every=None))
    state = term_ops.sync_terms(term_ops.sync_terms(stored, first), second)
    assert rows(term_streams.current_frequencies(spark, out)) == rows(state)


def test_updates_equal_batches_in_order(spark, feed, tmp_path):
    stored = frequencies(spark, ("a", 3), ("b", 1))
    parts = [
        frequencies(spark, ("a", -5), ("n", -1), name="frequency_delta"),
        frequencies(spark, ("a", 2), ("b", 1), ("b", 1), ("n", 4), name="frequency_delta"),
    ]
    out = str(tmp_path / "out")
    term_streams.seed_frequencies(stored, out)
    finish(term_streams.update_stream(feed("updates", *parts), out, str(tmp_path / "offsets")))
    state = stored
    for part in parts:
        queued = part.select("*", F.lit(False).alias("processed"), F.lit("x").alias("batch_id"))
        state = term_ops.apply_batch(state, queued)
    assert rows(term_streams.current_frequencies(spark, out)) == rows(state) == [(0, "a", 2), (0, "b", 3), (0, "n", 4)]


def test_documents_go_through_the_topic_into_the_index(spark, docs, feed, tmp_path):
    raw = [docs(a="red sea", b="blue").drop("shard_id"), docs(a="green", c="").drop("shard_id")]
    topics, out = str(tmp_path / "topics"), str(tmp_path / "out")
    for number, part in enumerate(raw):
        stream = feed(f"raw{number}", part)
        finish(ingest_streams.start_ingest(stream, F.lit("now"), f"{out}/{number}", str(tmp_path / f"in{number}"), folder=f"{topics}/{number}"))
    for number in (0, 1):
        stream = messages.read_document_stream(spark, f"{topics}/{number}")
        assert "seq" in stream.columns
        finish(index_streams.index_stream(stream, f"{out}/x{number}", str(tmp_path / f"idx{number}"), moment(NOW), stem=False))
    index = index_streams.current_index(spark, f"{out}/x0")
    assert rows(index.postings, "term", "doc_id", "tf") == [("blue", "b", 1), ("red", "a", 1), ("sea", "a", 1)]
    assert rows(index_streams.current_documents(spark, f"{out}/x1"), "doc_id", "content") == [("a", "green")]


def test_unfinished_batches_are_not_shown(spark, docs, feed, tmp_path):
    """Documents are written first; until the batch is indexed, too, readers see the batch before."""
    out = str(tmp_path / "out")
    finish(index_streams.index_stream(feed("docs", seq(docs(a="red"), 0)), out, "here", moment(NOW)))
    stored_documents.upsert_documents(spark, f"{out}/documents", seq(docs(z="red"), 0), moment(NOW), **{versions.batch_name("here"): "7"})
    assert rows(index_streams.current_documents(spark, out), "doc_id") == [("a",)]
    assert rows(index_streams.current_index(spark, out).doc_stats, "doc_id") == [("a",)]


def test_index_stream_merges_and_equals_batch_after_every_batch(spark, docs, feed, tmp_path):
    """Segments are merged every second batch; a search opens the buckets of its terms."""
    out, offsets, now = str(tmp_path / "out"), str(tmp_path / "offsets"), moment(NOW)
    state = docs().where("false")
    left = []
    for number in range(4):
        batch = seq(docs(**{f"d{number}": f"red w{chr(97 + number)}", "d0": f"blue {'x' * number}"}), 0)
        finish(index_streams.index_stream(feed("docs", batch), out, offsets, now, merge_after=2))
        state = table.upsert_documents(state, batch, now).drop("status")
        index = index_streams.current_index(spark, out)
        assert flat(index) == flat(index_ops.build_index(state))
        left.append(len(versions.read_version(spark, f"{out}/index").segments))
    assert left == [1, 0, 1, 0]
    assert index.buckets and "term_bucket" in index.postings.columns
    entries = index.postings.where(index_ops.term_bucket(index.buckets, F.lit("blue")) == F.col("term_bucket"))
    opened = [f for f in entries.where("term_bucket = " + str(entries.first()["term_bucket"])).inputFiles()]
    assert opened
    hits = search.search(index, index_streams.current_documents(spark, out), "red")
    assert rows(hits, "doc_id") == [("d1",), ("d2",), ("d3",)]


def test_a_replayed_batch_leaves_stored_tables_as_they_are(spark, docs, feed, tmp_path):
    out, now = str(tmp_path / "out"), moment(NOW)
    finish(index_streams.index_stream(feed("docs", seq(docs(a="red"), 0)), out, str(tmp_path / "o"), now))
    number = versions.versions(spark, f"{out}/index")
    version = versions.read_version(spark, f"{out}/index")
    assert versions.has_batch(version, str(tmp_path / "o"), 0) and not versions.has_batch(version, str(tmp_path / "o"), 1)
    assert not versions.has_batch(version, "another stream", 0)
    assert versions.versions(spark, f"{out}/index") == number


def test_an_update_batch_opens_touched_buckets_only(spark, tmp_path):
    out = str(tmp_path / "out")
    terms = [(f"term{k}", 5) for k in range(64)]
    term_streams.seed_frequencies(frequencies(spark, *terms), out)
    version = versions.read_version(spark, out)
    keys = frequencies(spark, ("term7", 1))
    opened = stored_terms.stored(spark, out, version, keys).inputFiles()
    own = keys.select(index_ops.term_bucket(16)).first()[0]
    assert opened and all(f"/term_bucket={own}/" in f for f in opened)
    stored_terms.apply_deltas(spark, out, frequencies(spark, ("term7", -2), name="frequency_delta"))
    old = versions.read_version(spark, out)
    new = stored_terms.merge_terms(spark, out)
    assert [p[2] for p in new.parts if new.parts[p] != old.parts.get(p)] == [own]
    state = {t: f for t, f in terms} | {"term7": 3}
    assert rows(stored_terms.open_terms(spark, out)) == sorted((0, t, f) for t, f in state.items())


def test_many_update_batches_equal_batches_in_order(spark, feed, tmp_path):
    import random

    rng, out = random.Random(3), str(tmp_path / "out")
    state = {f"t{k}": 3 for k in range(10)}
    term_streams.seed_frequencies(frequencies(spark, *state.items()), out)
    parts = [[(f"t{rng.randint(0, 20)}", rng.randint(-4, 4)) for _ in range(8)] for _ in range(7)]
    frames = [frequencies(spark, *part, name="frequency_delta") for part in parts]
    finish(term_streams.update_stream(feed("updates", *frames), out, str(tmp_path / "offsets"), merge_after=3))
    for part in parts:
        moved = {}
        for term, delta in part:
            moved[term] = moved.get(term, 0) + delta
        state |= {t: max(0, state.get(t, 0) + d) for t, d in moved.items()}
    expected = sorted((0, t, f) for t, f in state.items() if f > 0)
    assert rows(term_streams.current_frequencies(spark, out)) == expected
    assert len(versions.read_version(spark, out).segments) < 3


def test_a_micro_batch_is_cut_to_last_versions_once(spark, docs, feed, tmp_path, monkeypatch):
    def again(*_):
        raise AssertionError("the batch has each document once already")

    monkeypatch.setattr(stored_documents, "latest_versions", again)
    out = str(tmp_path / "out")
    batch = seq(docs(a="red", b="blue"), 0).unionByName(seq(docs(a="green"), 1))
    finish(index_streams.index_stream(feed("docs", batch), out, str(tmp_path / "offsets"), moment(NOW)))
    assert rows(index_streams.current_documents(spark, out), "doc_id", "content") == [("a", "green"), ("b", "blue")]


def test_a_stream_leaves_no_more_than_its_tables(spark, docs, feed, tmp_path):
    """With `keep`, merges drop what only older versions read; steps between are deleted after each batch."""
    out, now = str(tmp_path / "out"), moment(NOW)
    batches = [seq(docs(**{f"d{k}": f"red {'x' * k}", "d0": f"blue {'y' * k}"}), 0) for k in range(5)]
    settled = list(session._settled.get(spark.sparkContext.applicationId, []))
    stream = feed("docs", *batches)
    finish(index_streams.index_stream(stream, out, str(tmp_path / "offsets"), now, merge_after=2, keep=1))
    assert session._settled.get(spark.sparkContext.applicationId, []) == settled
    state = docs().where("false")
    for batch in batches:
        state = table.upsert_documents(state, batch, now).drop("status")
    assert rows(index_streams.current_documents(spark, out), "doc_id", "content") == rows(state, "doc_id", "content")
    assert flat(index_streams.current_index(spark, out)) == flat(index_ops.build_index(state))
    for name in ("documents", "index"):
        root = f"{out}/{name}"
        assert len(versions.versions(spark, root)) == 2  # the last merge, and the batch after it
        version = versions.read_version(spark, root)
        kept = session.list_paths(spark, f"{root}/*/shard_id=*/*/gen=*")
        assert len(kept) == len(version.parts)
        assert [p.rsplit("/", 1)[1] for p in session.list_paths(spark, f"{root}/segments/*")] == list(version.segments)


def test_files_of_a_stream_are_deleted_once_read(spark, tmp_path):
    stream = streams._stream_of(spark, "numbers", spark.range(40).repartition(40))
    seen = []
    finish(log.run(stream, lambda batch, n: seen.extend(r["id"] for r in batch.collect()), str(tmp_path / "offsets")))
    assert sorted(seen) == list(range(40))
    folder = stream._jdf.queryExecution().analyzed().toString()
    folder = re.search(r"FileSource\[([^\]]+)\]", folder)[1]
    for _ in range(100):
        left = session.list_paths(spark, f"{folder}/*.parquet")
        if len(left) <= 16:
            break
        time.sleep(0.1)
    assert len(left) <= 16  # those of the last batch may stay
