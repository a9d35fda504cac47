import random

import pytest

from pyspark.sql import functions as F

from conftest import rows
from lexiquarry.operators import terms as ops
from lexiquarry.plans.views import moment


def counters(spark, *items, shard=0):
    return spark.createDataFrame([(shard, t, f) for t, f in items], "shard_id int, term string, frequency bigint")


def deltas(spark, *items, shard=0):
    return spark.createDataFrame(
        [(shard, t, d) for t, d in items], "shard_id int, term string, frequency_delta bigint"
    )


def prefixes(spark, *items):
    return spark.createDataFrame([(p,) for p in items], "prefix string")


def buffer(spark, *items):
    frame = spark.createDataFrame(
        items, "term string, frequency_delta bigint, shard_id int, batch_id string, processed boolean, at string"
    )
    return frame.withColumn("created_at", F.to_timestamp("at")).drop("at")


def test_counts_repeat_and_skip_short_words(docs):
    counts = ops.term_counts(docs(a="Red red x", b="red running"), shards=1)
    assert rows(counts, "term", "frequency") == [("red", 3), ("running", 1)]


def test_signed_deltas(spark):
    before = counters(spark, ("a", 3), ("b", 1))
    changes = deltas(spark, (" A ", -5), ("b", 2), ("c", -1), ("d", 2), ("  ", 9))
    assert rows(ops.apply_increments(before, changes), "term", "frequency") == [
        ("a", -2),
        ("b", 3),
        ("c", -1),
        ("d", 2),
    ]
    assert rows(ops.update_frequency(before, changes), "term", "frequency") == [("b", 3), ("d", 2)]
    shown = ops.apply_increments(before, changes).select("term", ops.visible_frequency().alias("f"))
    assert rows(shown) == [("a", 0), ("b", 3), ("c", 0), ("d", 2)]


def test_removed_terms_are_tombstones_until_the_sync(spark):
    stored = counters(spark, ("a", 3), ("b", 1))
    after = ops.remove_terms(stored, stored.where("term = 'a'"))
    assert rows(after, "term", "frequency") == [("a", 0), ("b", 1)]
    assert rows(ops.live_terms(after), "term") == [("b",)]
    assert rows(ops.sync_terms(stored, after), "term", "frequency") == [("b", 1)]


def test_counters_expire(spark):
    log = buffer(
        spark,
        ("a", 1, 0, "x", False, "2024-01-01 00:00:00"),
        ("a", 1, 0, "x", False, "2024-01-02 12:00:00"),
        ("b", 1, 0, "x", False, "2024-01-01 00:00:00"),
    )
    now = moment("2024-01-02 18:00:00")
    assert rows(ops.expire_terms(log, now), "term", "frequency") == [("a", 1)]
    assert rows(ops.expire_terms(log, now, ttl="40 hours"), "term", "frequency") == [("a", 2)]
    assert rows(ops.expire_terms(log, now, ttl="40 hours", renew=False)) == []


def test_absent_terms_count_zero(spark):
    known = ops.assign_term_shard(counters(spark, ("red", 4)).drop("shard_id"))
    asked = spark.createDataFrame([(" Red",), ("blue",), ("",)], "term string")
    assert rows(ops.term_frequency(known, asked), "term", "frequency") == [("blue", 0), ("red", 4)]


def test_suggestions_against_brute_force(spark):
    random.seed(3)
    words = {"".join(random.choices("abc", k=random.randint(1, 6))) for _ in range(300)}
    known = [(w, random.randint(1, 20)) for w in sorted(words)]
    terms = counters(spark, *known)
    asked = ["a", "AB", " abc", "cc", "zzz", ""]
    expected = []
    for prefix in asked:
        p = prefix.lower().strip()
        best = sorted((w for w in known if w[0].startswith(p)), key=lambda w: (-w[1], w[0]))[:4]
        expected += [(p, t, f, i + 1) for i, (t, f) in enumerate(best)]
    got = rows(ops.suggest(terms, prefixes(spark, *asked), 4), "prefix", "term", "frequency", "rank")
    assert got == sorted(expected, key=repr)
    table = ops.build_prefix_table(terms, 4)
    looked = ops.lookup_prefixes(table, prefixes(spark, "a", "AB", "cc"))
    assert rows(looked, "prefix", "term", "frequency", "rank") == [r for r in got if r[0] in ("a", "ab", "cc")]
    for prefix in ("a", "", "  "):
        one = [tuple(r) for r in ops.suggest_one(terms, prefix, 4).collect()]
        assert one == [(t, f) for p, t, f, _ in sorted(expected, key=lambda r: r[3]) if p == prefix.strip()]


def test_prefix_join_is_not_a_nested_loop(spark):
    terms = counters(spark, ("red", 4))
    plan = ops.suggest(terms, prefixes(spark, "r"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_limits_are_kept_or_refused(spark):
    terms = spark.range(200).select(
        F.lit(0).alias("shard_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"), F.col("id").alias("frequency")
    )
    assert ops.suggest(terms, prefixes(spark, "t"), 80).count() == 80
    assert ops.typeahead(terms, prefixes(spark, "t"), 80).count() == 80
    assert ops.suggest_one(terms, "t", 80).count() == 80
    assert ops.popular_terms(terms, 150).count() == 150
    assert ops.suggest(terms, prefixes(spark, "t"), ops.clamp(80, ops.MAX_SUGGESTIONS)).count() == 50
    for refused in (
        lambda: ops.suggest(terms, prefixes(spark, "t"), 80, maximum=50),
        lambda: ops.suggest_one(terms, "t", 80, maximum=50),
        lambda: ops.popular_terms(terms, 150, maximum=100),
    ):
        with pytest.raises(ValueError, match="maximum"):
            refused()
    assert [r.frequency for r in ops.popular_terms(terms, 3).collect()] == [199, 198, 197]


def test_long_and_empty_prefixes(spark):
    terms = counters(spark, ("x" * 40, 4), ("x" * 39 + "y", 3), ("z", 1))
    asked = prefixes(spark, "", "x" * 33, "x" * 40, "z")
    expected = rows(ops.suggest(terms, asked, 2), "prefix", "term", "rank")
    assert len(expected) == 6
    whole = ops.build_prefix_table(terms, 2)
    assert rows(ops.lookup_prefixes(whole, asked), "prefix", "term", "rank") == expected
    short = ops.build_prefix_table(terms, 2, max_length=5)
    assert rows(ops.lookup_prefixes(short, asked, terms, 2, max_length=5), "prefix", "term", "rank") == expected
    with pytest.raises(ValueError, match="terms"):
        ops.lookup_prefixes(short, asked, max_length=5)


def test_an_expired_counter_starts_again(spark):
    log = buffer(
        spark,
        ("a", 5, 0, "x", False, "2024-01-01 00:00:00"),
        ("a", 1, 0, "x", False, "2024-01-02 06:00:00"),
    )
    now = moment("2024-01-02 07:00:00")
    assert rows(ops.expire_terms(log, now), "term", "frequency") == [("a", 1)]
    assert rows(ops.expire_terms(log, now, renew=False), "term", "frequency") == [("a", 1)]


@pytest.mark.parametrize("renew", [True, False])
def test_lives_against_brute_force(spark, renew):
    random.seed(5)
    writes = sorted((random.choice("abcdefgh"), random.randint(0, 240), random.choice([1, 2, -1])) for _ in range(150))
    log = buffer(spark, *((t, d, 0, "x", False, f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00") for t, h, d in writes))
    expected, end = [], 200
    for term in "abcdefgh":
        start = last = value = None
        for hour, delta in sorted((h, d) for t, h, d in writes if t == term and h <= end):
            if start is None or hour - (last if renew else start) >= 24:
                start, value = hour, 0
            last, value = hour, value + delta
        if start is not None and end - (last if renew else start) < 24:
            expected.append((term, value))
    got = ops.expire_terms(log, moment("2024-01-09 08:00:00"), renew=renew)
    assert rows(got, "term", "frequency") == expected


def test_merge_keeps_the_highest_frequency(spark):
    both = counters(spark, ("red", 4), ("rev", 2)).unionByName(counters(spark, ("red", 9), ("rex", 3), shard=1))
    got = ops.typeahead(both, prefixes(spark, "re"), 2)
    assert rows(got, "rank", "term", "frequency") == [(1, "red", 9), (2, "rex", 3)]


def test_sync_replaces_and_deletes(spark):
    stored = counters(spark, ("a", 5), ("b", 5), ("c", 5))
    counted = counters(spark, ("a", 2), ("b", 0), ("d", 1), ("e", -1))
    assert rows(ops.sync_terms(stored, counted), "term", "frequency") == [("a", 2), ("c", 5), ("d", 1)]
    assert rows(ops.sync_counts(stored, counted)) == [(0, 1, 1, 1)]
    assert rows(ops.sync_report(counted, stored)) == [(0, 4, 3, 5)]
    assert rows(ops.sync_terms(ops.sync_terms(stored, counted), counted)) == rows(ops.sync_terms(stored, counted))


def test_rebuild_replaces_instead_of_adding(spark):
    stored = counters(spark, ("a", 5), ("b", 5))
    once = ops.rebuild_terms(stored, counters(spark, ("a", 7)))
    assert rows(once, "term", "frequency") == [("a", 7), ("b", 5)]
    assert rows(ops.rebuild_terms(once, counters(spark, ("a", 7)))) == rows(once)


BATCH = (
    ("gone", -5, 0, "x", False, "2024-01-01 00:00:00"),
    ("up", 1, 0, "x", False, "2024-01-01 00:00:00"),
    ("up", 1, 0, "x", False, "2024-01-01 00:00:00"),
    ("new", 2, 0, "x", False, "2024-01-01 00:00:00"),
    ("never", -1, 0, "x", False, "2024-01-01 00:00:00"),
    ("done", 9, 0, "x", True, "2024-01-01 00:00:00"),
    ("other", 9, 0, "y", False, "2024-01-01 02:00:00"),
    ("shard", 9, 1, "x", False, "2024-01-01 02:00:00"),
)


def test_apply_batch(spark):
    stored = counters(spark, ("gone", 3), ("up", 1), ("kept", 1))
    updates = buffer(spark, *BATCH)
    after = ops.apply_batch(stored, updates, "x", 0)
    assert rows(after, "term", "frequency") == [("kept", 1), ("new", 2), ("up", 3)]
    assert rows(ops.batch_counts(stored, updates, "x", 0)) == [(0, 4, 2, 1)]


def test_processed_rows_and_cleanup(spark):
    marked = ops.mark_processed(buffer(spark, *BATCH), "x", 0)
    assert rows(marked.where("processed"), "term") == [
        (t,) for t in ("done", "gone", "never", "new", "up", "up")
    ]
    now = moment("2024-01-01 01:30:00")
    assert rows(ops.cleanup_buffer(marked, now), "term") == [("other",), ("shard",)]
    assert ops.cleanup_count(marked, now).first()[0] == 6


def test_queued_rows_get_a_batch_id(spark):
    rows_in = deltas(spark, ("a", 1)).withColumn("batch_id", F.lit(None).cast("string"))
    row = ops.queue_updates(rows_in, moment("2024-01-01 00:00:00")).first()
    assert len(row.batch_id) == 36 and row.processed is False


def test_summary_shows_empty_shards(spark):
    stats = ops.term_stats_summary(counters(spark, ("a", 1), ("b", 4)), shards=2)
    assert rows(stats) == [(0, 2, 2.5, 4, 1), (1, 0, 0.0, 0, 0)]


def test_scans(spark):
    both = counters(spark, ("a", 1), ("b", 4), ("z", 0)).unionByName(counters(spark, ("c", 9), shard=1))
    assert [r.term for r in ops.scan_terms(both, 0).collect()] == ["b", "a", "z"]
    assert rows(ops.scan_counters(both, 0), "term") == [("a",), ("b",), ("z",)]
    assert rows(ops.top_counters(both, 1), "shard_id", "term") == [(0, "b"), (1, "c")]


def test_prefix_table_kept_up_equals_a_rebuild(spark):
    import random

    from lexiquarry.session import settle

    rng = random.Random(5)
    now = {f"{rng.choice('ab')}{rng.choice('ab')}{k}": rng.randint(1, 5) for k in range(30)}
    frame = lambda d: spark.createDataFrame([(0, t, f) for t, f in d.items()], "shard_id int, term string, frequency bigint")
    for longest in (None, 2):
        table = settle(ops.build_prefix_table(frame(now), 3, longest))
        for _ in range(3):
            moved = {t: rng.randint(-6, 6) for t in rng.sample(sorted(now), 4)} | {f"a{rng.randint(0, 99)}": 9}
            now = {t: f for t, f in ({**now, **{t: now.get(t, 0) + d for t, d in moved.items()}}).items() if f > 0}
            table = settle(ops.update_prefix_table(table, frame(now), frame(moved), 3, longest))
            assert rows(table) == rows(ops.build_prefix_table(frame(now), 3, longest))


def test_changes_of_documents_move_counts(spark, docs, tmp_path):
    from lexiquarry.operators import stored_documents
    from lexiquarry.plans.views import moment
    from lexiquarry.sources import versions

    root, now = str(tmp_path), moment("2024-01-01 00:00:00")
    first = docs(a="red sea red", b="blue", c="green")
    stored_documents.create_documents(first, root)
    stored_documents.upsert_documents(spark, root, docs(a="red moon", d="blue").withColumn("seq", F.lit(0)), now)
    stored_documents.delete_documents(spark, root, docs(c="", nobody=""))
    feed = stored_documents.changes(spark, root, since=0)
    assert rows(feed, "doc_id", "content", "change") == [("a", "red moon", 1), ("a", "red sea red", -1), ("c", "green", -1), ("d", "blue", 1)]
    counts = ops.apply_increments(ops.term_counts(first), ops.term_changes(feed)).where("frequency <> 0")
    after = stored_documents.open_documents(spark, root)
    assert rows(counts, "term", "frequency") == rows(ops.term_counts(after), "term", "frequency")
    events = ops.apply_increments(ops.term_counts(first), ops.term_changes(feed, mode="events"))
    assert dict(rows(events, "term", "frequency")) == {"red": 3, "sea": 1, "blue": 2, "green": 1, "moon": 1}
    assert stored_documents.changes(spark, root, since=2).count() == 0
    stored_documents.merge_documents(spark, root)
    with pytest.raises(ValueError, match="merged"):
        stored_documents.changes(spark, root, since=versions.versions(spark, root)[0])
    with pytest.raises(ValueError, match="mode"):
        ops.term_changes(feed, mode="other")
