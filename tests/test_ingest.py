import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lexiquarry.functions.hashing import shard_of
from lexiquarry.operators import ingest
from lexiquarry.sources import messages


@pytest.mark.parametrize(
    ("payload", "error"),
    [
        ({"content": "ok", "title": "t", "source": "s", "metadata": {"tags": ["a", 1]}}, ""),
        ({"title": "t"}, ingest.CONTENT_MISSING),
        ({"content": None}, ingest.CONTENT_EMPTY),
        ({"content": ""}, ingest.CONTENT_EMPTY),
        ({"content": 5}, ingest.CONTENT_EMPTY),
        ({"content": "x" * 21}, ingest.CONTENT_TOO_LONG),
        ({"content": "ok", "title": None}, ingest.TITLE_TYPE),
        ({"content": "ok", "title": 1, "source": 2}, ingest.TITLE_TYPE),
        ({"content": "ok", "source": ["s"]}, ingest.SOURCE_TYPE),
        ({"content": "ok", "metadata": "m"}, ingest.METADATA_TYPE),
        ({"content": "ok", "metadata": None}, ingest.METADATA_TYPE),
        ({}, ingest.NO_DATA),
        ("[]", ingest.NO_DATA),
        ("null", ingest.NO_DATA),
        ("false", ingest.NO_DATA),
        (" 0.0 ", ingest.NO_DATA),
        ('""', ingest.NO_DATA),
        ("{ }", ingest.NO_DATA),
        ("[1]", ingest.CONTENT_MISSING),
        ('"text"', ingest.CONTENT_MISSING),
        ("7", ingest.CONTENT_MISSING),
        ('{"content": "", "content": "last wins"}', ""),
        ('{"content": "x", "content": null}', ingest.CONTENT_EMPTY),
        ("{broken", ingest.MALFORMED),
    ],
)
def test_json_rules(spark, payload, error):
    line = payload if isinstance(payload, str) else json.dumps(payload)
    frame = spark.createDataFrame([(line,)], "payload string")
    row = ingest.validate_json(frame, max_chars=20).first()
    assert (row.error, row.valid, row.payload) == (error, error == "", line)


def test_parsed_fields(spark):
    line = json.dumps({"id": "a", "content": "text", "metadata": {"n": 1, "tags": ["x", "y"]}})
    row = ingest.validate_json(spark.createDataFrame([(line,)], "payload string")).first()
    assert (row.doc_id, row.content, row.title) == ("a", "text", None)
    assert row.metadata == {"n": "1", "tags": '["x","y"]'}


def test_fields_of_other_types(spark):
    lines = ['{"id": 5, "content": "a"}', '{"id": null, "content": "a"}', '{"id": [1], "content": "a", "id": ""}', '{"content": "a"}']
    frame = spark.createDataFrame([(x,) for x in lines], "payload string")
    assert [r.doc_id for r in ingest.validate_json(frame).collect()] == ["5", None, "", None]
    frame = spark.createDataFrame([('{"content": "a", "metadata": {"a": null, "b": true, "c": {"d": [1.5]}}}',)], "payload string")
    assert ingest.validate_json(frame).first().metadata == {"a": None, "b": "true", "c": '{"d":[1.5]}'}


def test_nested_metadata_keeps_its_types(spark):
    given = {"tags": ["x", "y"], "n": 1.5, "deep": {"z": None}, "word_count": 99}
    frame = spark.createDataFrame([(json.dumps({"id": "a", "content": "one two", "metadata": given}),), ('{"id": "b", "content": "c"}',)], "payload string")
    read = ingest.enrich(ingest.validate_json(frame, nested=True), "now")
    first, second = read.select(F.to_json("metadata").alias("m")).collect()
    added = {"ingested_at": "now", "ingestion_service": "data-ingestion"}
    assert json.loads(first.m) == {**given, **added, "content_length": 7, "word_count": 2}
    assert json.loads(second.m) == {**added, "content_length": 1, "word_count": 1}


def test_the_payload_is_parsed_once(spark):
    frame = spark.createDataFrame([("{}",)], "payload string")
    plan = ingest.validate_json(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") <= 1 and "get_json_object" not in plan


def test_results_analyze_a_text_once(spark, docs):
    found = ingest.document_results(docs(a="Running runs of a whale, x y"))
    assert tuple(found.select("tokens_processed", "typeahead_terms").first()) == (4, 3)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_typed_null_is_absent(spark):
    frame = spark.createDataFrame([(None,), ("",), ("x",)], "content string")
    errors = [r.error for r in ingest.validate(frame).collect()]
    assert errors == [ingest.CONTENT_MISSING, ingest.CONTENT_EMPTY, ""]


def test_size_limit_is_in_characters(spark):
    frame = spark.createDataFrame([("é" * 10,), ("é" * 11,)], "content string")
    assert [r.valid for r in ingest.validate(frame, max_chars=10).collect()] == [True, False]


def test_enrich_overrides_given_entries(spark):
    frame = spark.createDataFrame(
        [("one  two", {"word_count": "9", "k": "v"}), ("x", None)],
        "content string, metadata map<string,string>",
    )
    first, second = [r.metadata for r in ingest.enrich(frame, "now").collect()]
    assert first == {
        "k": "v",
        "ingested_at": "now",
        "ingestion_service": "data-ingestion",
        "content_length": "8",
        "word_count": "2",
    }
    assert second["word_count"] == "1"


def test_ids_and_shards_are_stable(spark):
    frame = spark.createDataFrame([("", "a"), (None, "a"), ("x", "a")], "doc_id string, content string")
    ids = [r.doc_id for r in ingest.assign_doc_id(frame).collect()]
    assert ids == ["0cc175b9c0f1b6a831c399e269772661"] * 2 + ["x"]
    shards = spark.range(1000).select(shard_of(F.col("id").cast("string"), 3).alias("s"))
    assert {r.s for r in shards.distinct().collect()} == {0, 1, 2}


def test_bulk_payloads(spark):
    bulk = spark.createDataFrame(
        [
            (1, json.dumps({"documents": [{"content": "a"}, {"content": "b", "metadata": {"k": [1]}}]})),
            (2, json.dumps({"documents": []})),
            (3, json.dumps({"other": 1})),
            (4, json.dumps({"documents": {"content": "a"}})),
        ],
        "batch_id int, payload string",
    )
    got = rows(messages.explode_bulk(bulk), "batch_id", "position", "document", "error")
    assert [(r[0], r[1], r[3]) for r in got] == [
        (1, 0, ""),
        (1, 1, ""),
        (2, None, messages.ARRAY_EMPTY),
        (3, None, messages.ARRAY_REQUIRED),
        (4, None, messages.ARRAY_TYPE),
    ]
    assert json.loads(got[1][2]) == {"content": "b", "metadata": {"k": [1]}}


def test_oversized_batch_is_rejected_whole(spark):
    frame = spark.range(30).select(F.when(F.col("id") < 25, "big").otherwise("small").alias("batch_id"))
    checked = ingest.check_batch_size(frame, max_documents=20)
    assert rows(checked.groupBy("batch_id", "error").count()) == [
        ("big", ingest.BATCH_TOO_LARGE, 25),
        ("small", "", 5),
    ]


def test_accept_keeps_rejected_rows(spark, docs):
    frame = docs(a="fine", b="").drop("shard_id")
    done = ingest.accept(frame, "now")
    assert rows(done, "doc_id", "valid", "error") == [("a", True, ""), ("b", False, ingest.CONTENT_EMPTY)]
    assert done.where("doc_id = 'b' and shard_id is null and metadata is null").count() == 1


def test_a_filter_on_the_verdict_does_not_parse_again(spark):
    frame = spark.createDataFrame([('{"content": "x"}',)], "payload string")
    for nested in (False, True):
        plan = ingest.validate_json(frame, nested=nested).where("valid")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1


def test_objects_with_empty_fields_are_data(spark):
    texts = ['{"a": null}', '{"content": ""}', "{}", " { } ", '[{}]', "[]", "null", "0", "0.0", "false", '""', "7", "[null]", None, "{"]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, payload string")
    errors = [r.error for r in ingest.validate_json(frame).orderBy("n").collect()]
    nothing, missing = ingest.NO_DATA, ingest.CONTENT_MISSING
    assert errors == [missing, ingest.CONTENT_EMPTY, nothing, nothing, missing, *[nothing] * 6, missing, missing, ingest.MALFORMED, ingest.MALFORMED]


def test_nested_documents_are_parsed_once_for_both_writes(spark, tmp_path, monkeypatch):
    from lexiquarry.plans import ingest as plans

    rows = [(n, "en", "s", "two words", 9) for n in range(4)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    given, create, upsert = [], plans.stored.create_documents, plans.stored.upsert_documents
    monkeypatch.setattr(plans.stored, "create_documents", lambda docs, *a: (given.append(docs), create(docs, *a))[1])
    monkeypatch.setattr(plans.stored, "upsert_documents", lambda s, root, docs, *a: (given.append(docs), upsert(s, root, docs, *a))[1])
    assert plans.src08_nested_metadata(spark, str(tmp_path)).count() == 4
    plans_of = [d._jdf.queryExecution().logical().toString().lower() for d in given]
    assert len(given) == 2 and not any("from_json" in p or "parsejson" in p or "parse_json" in p for p in plans_of)
