from pyspark.sql import functions as F

from conftest import rows
from lexiquarry.operators import documents as table
from lexiquarry.plans.views import moment

LATER = "2024-06-01 00:00:00"


def seq(df, n):
    return df.withColumn("seq", F.lit(n).cast("bigint"))


def test_upsert_keeps_creation_time_and_takes_the_last_version(docs):
    current = docs(a="old", b="same")
    batch = seq(docs(a="first", c="new"), 1).unionByName(seq(docs(a="last", c="newer"), 2))
    after = table.upsert_documents(current, batch, moment(LATER))
    moved = F.col("created_at") != F.col("updated_at")
    assert rows(after.withColumn("moved", moved), "doc_id", "content", "status", "moved") == [
        ("a", "last", "updated", True),
        ("b", "same", "unchanged", False),
        ("c", "newer", "indexed", False),
    ]
    results = table.upsert_results(current, batch)
    assert rows(results, "doc_id", "seq", "status") == [
        ("a", 1, "updated"),
        ("a", 2, "updated"),
        ("c", 1, "indexed"),
        ("c", 2, "updated"),
    ]


def test_hundred_requests_for_five_documents(spark, docs):
    texts = [(f"text {n % 5}", n) for n in range(100)]
    frame = spark.createDataFrame(texts, "content string, seq bigint")
    batch = frame.select(
        F.md5("content").alias("doc_id"),
        F.lit("").alias("title"),
        "content",
        F.lit("load").alias("source"),
        F.create_map(F.lit("n"), F.col("seq").cast("string")).alias("metadata"),
        F.lit(0).alias("shard_id"),
        "seq",
    )
    after = table.upsert_documents(docs().where("false"), batch, moment(LATER))
    assert after.count() == 5
    assert sorted(int(r.metadata["n"]) for r in after.collect()) == [95, 96, 97, 98, 99]


def test_a_hot_document_is_pruned_before_the_shuffle(docs):
    plan = table.latest_versions(seq(docs(a="x"), 1))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_delete_and_its_results(docs):
    stored = docs(a="x", b="y")
    ids = docs(a="", z="").select("shard_id", "doc_id")
    assert rows(table.delete_documents(stored, ids), "doc_id") == [("b",)]
    assert rows(table.delete_results(stored, ids), "doc_id", "status", "error") == [
        ("a", "deleted", ""),
        ("z", "", table.NOT_FOUND),
    ]


def test_upsert_then_delete_is_the_original(docs):
    stored = docs(a="x", b="y")
    batch = seq(docs(c="new"), 1)
    after = table.upsert_documents(stored, batch, moment(LATER))
    back = table.delete_documents(after, batch)
    assert rows(back, "doc_id", "content", "created_at") == rows(stored, "doc_id", "content", "created_at")


def test_lookups(spark, docs):
    stored = docs(a="x", b="y")
    assert rows(table.get_document(stored, "a", 0), "content") == [("x",)]
    assert table.get_document(stored, "nope").count() == 0
    ids = spark.createDataFrame([("b",), ("nope",)], "doc_id string")
    assert rows(table.fetch_documents(stored, ids, shard_id=0), "doc_id") == [("b",)]


def test_shard_metadata_shows_empty_shards(docs):
    meta = table.shard_metadata(docs(a="x", b="y"), 3)
    assert rows(meta, "shard_id", "document_count", "status") == [
        (0, 2, "active"),
        (1, 0, "active"),
        (2, 0, "active"),
    ]
    assert table.seed_shards(meta, 3).count() == 3
