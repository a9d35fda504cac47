import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexiquarry import session
from lexiquarry.operators import ingest
from lexiquarry.sources import messages, tables


def counts(spark, n):
    return spark.range(n).select(
        F.pmod("id", F.lit(2)).cast("int").alias("shard_id"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"),
        (F.col("id") + 1).alias("frequency"),
    )


def test_documents_round_trip_with_partition_pruning(spark, docs, tmp_path):
    frame = docs(a="x", b="y", c=None, d="z", shards=3)
    path = str(tmp_path / "documents")
    tables.write_documents(frame, path)
    stored = tables.read_documents(spark, path)
    assert rows(stored, "shard_id", "doc_id", "content") == rows(frame, "shard_id", "doc_id", "content")
    one = tables.scan_documents(stored, 1)
    assert rows(one) == [(i, t, c or "") for s, i, t, c in rows(frame, "shard_id", "doc_id", "title", "content") if s == 1]
    assert "PartitionFilters: [isnotnull(shard_id" in one._jdf.queryExecution().executedPlan().toString()


def test_terms_round_trip_and_prefix_pushdown(spark, tmp_path):
    from lexiquarry.operators.terms import suggest_one

    path = str(tmp_path / "terms")
    tables.write_terms(counts(spark, 50), path)
    stored = tables.read_terms(spark, path)
    assert rows(stored, "shard_id", "term", "frequency") == rows(counts(spark, 50))
    plan = suggest_one(stored, "T1")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(term,t1)" in plan


def test_json_lines_keep_malformed_rows(spark, tmp_path):
    lines = [json.dumps({"id": "a", "content": "ok"}), "{oops", json.dumps({"id": "b"})]
    (tmp_path / "in.json").write_text("\n".join(lines))
    read = messages.read_json_documents(spark, str(tmp_path / "in.json"))
    assert rows(read, "payload", "error") == sorted(
        [(lines[0], ""), (lines[1], ingest.MALFORMED), (lines[2], ingest.CONTENT_MISSING)], key=repr
    )


def test_document_messages(docs):
    message = messages.document_messages(docs(("a", "t", "c"))).first()
    body = json.loads(message.value)
    assert message.key == "shard-0"
    assert (body["id"], body["title"], body["content"], body["shard_id"]) == ("a", "t", "c", 0)


def test_term_messages_are_small_and_complete(spark):
    made = messages.term_update_messages(counts(spark, 500), terms_per_message=20)
    bodies = [json.loads(r.value) for r in made.collect()]
    assert all(body["action"] == "update_terms" for body in bodies)
    assert max(len(body["terms"]) for body in bodies) < 60
    back = messages.parse_term_updates(made)
    assert rows(back, "shard_id", "term", "frequency_delta") == rows(counts(spark, 500))


def test_published_folder_is_read_as_a_stream(spark, docs, tmp_path):
    messages.publish_documents(docs(a="x", b="y"), str(tmp_path))
    stream = messages.read_document_stream(spark, str(tmp_path))
    out = str(tmp_path / "out")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "offsets"))
        .trigger(availableNow=True)
        .start(out)
    )
    assert query.awaitTermination(120)
    assert rows(spark.read.parquet(out), "doc_id", "content") == [("a", "x"), ("b", "y")]


def test_small_sides_are_stored_and_judged_by_their_bytes(spark):
    side = session.lookup_side(spark.range(1000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("x")))
    wide = spark.range(5000)
    plan = wide.join(side, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SinglePartition" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        beyond = wide.join(side, "id")
        assert "SortMergeJoin" in beyond._jdf.queryExecution().executedPlan().toString()
        assert beyond.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_settled_folders_can_be_released(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_settled", {})
    kept = session.settle(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(kept)
    assert session.release(spark) == 1
    assert not os.path.exists(kept)


class Session:
    """Just what `shared_folder` asks a session for."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master, self.applicationId = master, "app"


def test_shared_folder_is_the_configured_one():
    session_with = Session("hdfs://shared/x/", "yarn")
    first, second = (session.shared_folder(session_with, "t") for _ in range(2))
    assert first.startswith("hdfs://shared/x/t-") and first != second


def test_only_a_local_session_may_go_without():
    assert session.shared_folder(Session(None, "local[2]"), "t")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(None, "yarn"), "t")


def test_spread_leaves_well_split_scans_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    wide, narrow = spark.range(0, 100, numPartitions=cores), spark.range(0, 100, numPartitions=1)
    assert session.spread(wide, "id") is wide
    assert session.spread(narrow, "id").rdd.getNumPartitions() > 1


@pytest.mark.parametrize("table", ["documents", "terms"])
def test_jdbc_needs_a_driver(spark, table):
    """No driver is on the class path here; the call must reach Spark's reader."""
    with pytest.raises(Exception, match="(?i)driver"):
        tables.read_jdbc(spark, "jdbc:postgresql://db/search", table).count()


def test_nested_metadata_through_json_messages_parquet_and_hits(spark, tmp_path):
    """An array and a number make the whole way."""
    from lexiquarry.operators import index, ingest, search, stored_documents
    from lexiquarry.plans.views import moment

    given = {"tags": ["red", "sea"], "n": 3, "deep": {"on": True}}
    (tmp_path / "in.json").write_text(json.dumps({"id": "a", "title": "t", "content": "red whale", "metadata": given}))
    read = messages.read_json_documents(spark, str(tmp_path / "in.json"), nested=True)
    ready = ingest.assign_shard(ingest.enrich(read, "now"), shards=1)
    messages.publish_documents(ready, str(tmp_path / "topics"))
    sent = spark.read.schema(messages.MESSAGE).json(f"{tmp_path}/topics/{messages.DOCUMENT_TOPIC}")
    got = messages.parse_documents(sent, nested=True)
    now = moment("2024-01-01 00:00:00")
    got = got.withColumns({"created_at": now, "updated_at": now, "seq": F.lit(1)})
    root = str(tmp_path / "stored")
    stored_documents.create_documents(got.where("false"), root)
    stored_documents.upsert_documents(spark, root, got, now)
    stored_documents.merge_documents(spark, root)
    docs = stored_documents.open_documents(spark, root)
    hit = search.search(index.build_index(docs), docs, "whale").select("doc_id", F.to_json("metadata").alias("m")).first()
    assert hit.doc_id == "a" and {k: json.loads(hit.m)[k] for k in given} == given
    assert json.loads(hit.m)["word_count"] == 2
