"""Term counters, the update buffer and typeahead over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiquarry.operators import stored_documents as stored
from lexiquarry.operators import terms as ops
from lexiquarry.plans import sql, views
from lexiquarry.session import settle, shared_folder
from lexiquarry.sources import messages, tables

LIMIT = 10


def src04_scan_terms(spark, sf):
    return ops.scan_terms(views.stored_terms(spark, sf), 0)


def src05_scan_counters(spark, sf):
    return ops.scan_counters(views.counters(spark, sf), 1)


def src07_terms_round_trip(spark, sf):
    folder = shared_folder(spark, "terms")
    tables.write_terms(views.stored_terms(spark, sf), folder)
    return tables.read_terms(spark, folder).select("shard_id", "term", "frequency")


def src11_publish_term_updates(spark, sf):
    folder = shared_folder(spark, "topics")
    messages.publish_term_updates(views.stored_terms(spark, sf), folder)
    sent = spark.read.schema(messages.MESSAGE).json(f"{folder}/{messages.TERM_TOPIC}")
    return messages.parse_term_updates(sent)


def trm01_term_counts(spark, sf):
    return views.stored_terms(spark, sf)


def _changed_documents(spark, sf):
    """A stored table of which the reviewed documents are retitled and the toxic ones deleted, and its changes."""
    root = shared_folder(spark, "stored")
    stored.create_documents(views.documents(spark, sf), root)
    batch = views.reviewed(spark, sf).withColumn("seq", F.lit(0))
    stored.upsert_documents(spark, root, batch, views.moment(views.NOW))
    stored.delete_documents(spark, root, views.toxic(spark, sf))
    return stored.changes(spark, root, since=0)


def trm01_term_counts_by_changes(spark, sf):
    moved = ops.term_changes(_changed_documents(spark, sf))
    return ops.apply_increments(views.stored_terms(spark, sf), moved).where("frequency <> 0")


def trm01_term_counts_by_events(spark, sf):
    """As the services count: a new version adds, nothing is taken back."""
    moved = ops.term_changes(_changed_documents(spark, sf), mode="events")
    return ops.apply_increments(views.stored_terms(spark, sf), moved)


def trm11_update_prefix_table(spark, sf):
    """The table kept in step with a sync of the counters."""
    before = views.stored_terms(spark, sf)
    after = ops.sync_terms(before, views.counters(spark, sf))
    table = ops.build_prefix_table(before, k=5)
    return ops.update_prefix_table(table, settle(after), views.counters(spark, sf), k=5)


def trm02_apply_increments(spark, sf):
    return ops.apply_increments(views.event_terms(spark, sf), views.updates(spark, sf))


def trm03_update_frequency(spark, sf):
    return ops.update_frequency(views.event_terms(spark, sf), views.updates(spark, sf))


def trm03_visible_frequency(spark, sf):
    counters = ops.apply_increments(views.event_terms(spark, sf), views.updates(spark, sf))
    return counters.select("shard_id", "term", ops.visible_frequency().alias("frequency"))


def trm04_remove_terms(spark, sf):
    return ops.remove_terms(views.stored_terms(spark, sf), views.benchmark_terms(spark, sf))


def trm04_live_terms(spark, sf):
    return ops.live_terms(views.counters(spark, sf))


def trm05_expire_terms(spark, sf):
    return ops.expire_terms(views.updates(spark, sf), views.moment(views.NOW))


def trm05_expire_terms_fixed(spark, sf):
    now = views.moment(views.NOW)
    return ops.expire_terms(views.updates(spark, sf), now, ttl="29 days", renew=False)


def trm05_expire_terms_fixed_short(spark, sf):
    """Several lives of a counter, each of four days from its first write."""
    return ops.expire_terms(views.updates(spark, sf), views.moment(views.NOW), ttl="4 days", renew=False)


def trm06_term_frequency(spark, sf):
    asked = views.prefixes(spark, sf).withColumnRenamed("prefix", "term")
    return ops.term_frequency(views.stored_terms(spark, sf), asked)


def trm07_suggest(spark, sf):
    return ops.suggest(views.stored_terms(spark, sf), views.prefixes(spark, sf), LIMIT)


def trm07_suggest_shard(spark, sf):
    return ops.suggest(views.stored_terms(spark, sf), views.prefixes(spark, sf), LIMIT, per_shard=True)


def trm07_suggest_popular(spark, sf):
    """Blank prefixes: every answer is the list of popular terms."""
    blank = views.prefixes(spark, sf).select(F.lit(" ").alias("prefix"))
    return ops.suggest(views.stored_terms(spark, sf), blank, LIMIT)


def trm08_popular_terms(spark, sf):
    return ops.popular_terms(views.stored_terms(spark, sf))


def trm09_merge_suggestions(spark, sf):
    """The corpus and the messages as two lists with terms in common."""
    counted = views.counters(spark, sf).unionByName(views.stored_terms(spark, sf))
    spelled = ops.suggest(counted, views.prefixes(spark, sf), 2 * LIMIT, per_shard=True)
    return ops.merge_suggestions(spelled, LIMIT)


def trm09_typeahead(spark, sf):
    return ops.typeahead(views.stored_terms(spark, sf), views.prefixes(spark, sf), LIMIT)


def trm11_build_prefix_table(spark, sf):
    return ops.build_prefix_table(views.stored_terms(spark, sf), k=5)


def trm11_lookup_prefixes(spark, sf):
    table = ops.build_prefix_table(views.stored_terms(spark, sf), LIMIT)
    return ops.lookup_prefixes(table, _odd_prefixes(spark, sf))


def trm11_lookup_beyond_the_table(spark, sf):
    """A table of short prefixes; longer ones come from the terms."""
    terms = views.stored_terms(spark, sf)
    table = ops.build_prefix_table(terms, LIMIT, max_length=3)
    return ops.lookup_prefixes(table, _odd_prefixes(spark, sf), terms, LIMIT, max_length=3)


def trm07_suggest_odd_prefixes(spark, sf):
    return ops.suggest(views.stored_terms(spark, sf), _odd_prefixes(spark, sf), LIMIT)


def trm09_typeahead_limit_80(spark, sf):
    """More than any limit of the services."""
    return ops.typeahead(views.stored_terms(spark, sf), _odd_prefixes(spark, sf), 80)


def trm10_limit(spark, sf):
    """The services' own limit, asked for by the caller."""
    limit = ops.clamp(80, ops.MAX_SUGGESTIONS)
    return ops.suggest(views.stored_terms(spark, sf), _odd_prefixes(spark, sf), limit, maximum=ops.MAX_SUGGESTIONS)


def _odd_prefixes(spark, sf):
    """All asked prefixes, the empty one, and one of forty letters."""
    long = spark.range(1).select(F.repeat(F.lit("x"), 40).alias("prefix"))
    empty = spark.range(1).select(F.lit("").alias("prefix"))
    return views.prefixes(spark, sf).unionByName(long).unionByName(empty)


def trm12_rebuild_terms(spark, sf):
    return ops.rebuild_terms(views.stored_terms(spark, sf), views.counters(spark, sf))


def trm13_sync_terms(spark, sf):
    return ops.sync_terms(views.stored_terms(spark, sf), views.counters(spark, sf))


def trm13_sync_counts(spark, sf):
    return ops.sync_counts(views.stored_terms(spark, sf), views.counters(spark, sf))


def trm14_overlay_terms(spark, sf):
    return ops.overlay_terms(views.event_terms(spark, sf), ops.apply_increments(views.event_terms(spark, sf), views.updates(spark, sf)))


def trm15_queue_updates(spark, sf):
    queued = ops.queue_updates(views.updates(spark, sf), F.col("created_at"))
    return queued.select("term", "frequency_delta", "shard_id", "batch_id", "processed")


def trm16_apply_batch(spark, sf):
    return ops.apply_batch(views.event_terms(spark, sf), views.updates(spark, sf))


def trm16_apply_named_batch(spark, sf):
    return ops.apply_batch(views.event_terms(spark, sf), views.updates(spark, sf), "2024-01-21", 1)


def trm16_batch_counts(spark, sf):
    return ops.batch_counts(views.event_terms(spark, sf), views.updates(spark, sf))


def trm17_mark_processed(spark, sf):
    done = ops.mark_processed(views.updates(spark, sf), "2024-01-21", 1)
    return done.groupBy("shard_id", "batch_id", "processed").agg(F.count("*").alias("n"))


def trm18_cleanup_buffer(spark, sf):
    left = ops.cleanup_buffer(views.updates(spark, sf), views.moment(views.PROCESSED_UNTIL), "36 hours")
    return left.select("term", "frequency_delta", "shard_id", "batch_id", "processed")


def trm18_cleanup_count(spark, sf):
    return ops.cleanup_count(views.updates(spark, sf), views.moment(views.NOW))


def trm19_term_stats_summary(spark, sf):
    stats = ops.term_stats_summary(views.stored_terms(spark, sf), shards=3)
    return stats.withColumn("avg_frequency", F.round("avg_frequency", 6))


def trm20_sync_report(spark, sf):
    return ops.sync_report(views.counters(spark, sf), views.stored_terms(spark, sf))


def trm20_top_counters(spark, sf):
    return ops.top_counters(views.counters(spark, sf))


def trm21_assign_term_shard(spark, sf):
    words = views.messages(spark, sf).select(F.explode(F.split("content", r"\s+")).alias("term"))
    return ops.assign_term_shard(words.distinct())


QUERIES = {
    f.__name__: f
    for f in (
        src04_scan_terms,
        src05_scan_counters,
        src07_terms_round_trip,
        src11_publish_term_updates,
        trm01_term_counts,
        trm01_term_counts_by_changes,
        trm01_term_counts_by_events,
        trm11_update_prefix_table,
        trm02_apply_increments,
        trm03_update_frequency,
        trm03_visible_frequency,
        trm04_remove_terms,
        trm04_live_terms,
        trm05_expire_terms,
        trm05_expire_terms_fixed,
        trm05_expire_terms_fixed_short,
        trm06_term_frequency,
        trm07_suggest,
        trm07_suggest_shard,
        trm07_suggest_popular,
        trm07_suggest_odd_prefixes,
        trm09_typeahead_limit_80,
        trm10_limit,
        trm11_lookup_beyond_the_table,
        trm08_popular_terms,
        trm09_merge_suggestions,
        trm09_typeahead,
        trm11_build_prefix_table,
        trm11_lookup_prefixes,
        trm12_rebuild_terms,
        trm13_sync_terms,
        trm13_sync_counts,
        trm14_overlay_terms,
        trm15_queue_updates,
        trm16_apply_batch,
        trm16_apply_named_batch,
        trm16_batch_counts,
        trm17_mark_processed,
        trm18_cleanup_buffer,
        trm18_cleanup_count,
        trm19_term_stats_summary,
        trm20_sync_report,
        trm20_top_counters,
        trm21_assign_term_shard,
    )
}

_STORED = sql.with_(*sql.STORED)
_BOTH = (*sql.STORED, *sql.COUNTERS)
_EVENTS = (sql.UPDATES, sql.EVENT_TERMS)
_ORDER = "ORDER BY frequency DESC, term"
_SUMMED = (
    "summed AS (SELECT shard_id, term, CAST(sum(f) AS BIGINT) AS frequency FROM "
    "(SELECT shard_id, term, frequency AS f FROM event_terms UNION ALL "
    "SELECT shard_id, term, frequency_delta FROM updates) GROUP BY ALL)"
)


def _top(source: str, k: int, by: str, columns: str) -> str:
    return (
        f"SELECT {columns}, row_number() OVER (PARTITION BY {by} {_ORDER}) AS rank FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {by} {_ORDER}) <= {k}"
    )


def _matches(source: str, prefixes: str = "prefixes") -> str:
    return f"matches AS (SELECT prefix, t.* FROM {prefixes} JOIN {source} t ON starts_with(t.term, prefix))"


_ODD = "odd AS (SELECT prefix FROM prefixes UNION SELECT '' UNION SELECT repeat('x', 40))"


_SYNCED = (
    "SELECT shard_id, term, coalesce(c.frequency, s.frequency) AS frequency "
    "FROM {stored} s FULL JOIN {counters} c USING (shard_id, term) "
    "WHERE coalesce(c.frequency, s.frequency) > 0"
)
_PAIRS = (
    "pairs AS (SELECT shard_id, s.frequency AS s, c.frequency AS c "
    "FROM stored s FULL JOIN counters c USING (shard_id, term))"
)


def _deltas(where: str) -> str:
    return (
        "deltas AS (SELECT shard_id, term, CAST(sum(frequency_delta) AS BIGINT) AS delta FROM updates "
        f"WHERE {where} GROUP BY ALL)"
    )


_PENDING = _deltas("NOT processed")
_NAMED = _deltas("NOT processed AND batch_id = '2024-01-21' AND shard_id = 1")
_APPLIED = (
    "SELECT shard_id, term, coalesce(frequency, 0) + coalesce(delta, 0) AS frequency "
    "FROM event_terms FULL JOIN deltas USING (shard_id, term) "
    "WHERE coalesce(frequency, 0) + coalesce(delta, 0) > 0"
)
_NOW = "TIMESTAMP '2024-01-31'"
_WRITTEN = f"written AS (SELECT * FROM updates WHERE created_at <= {_NOW})"
# A term's writes numbered by life: a break of the ttl or more begins another.
_RENEWED = (
    "broken AS (SELECT *, coalesce(created_at - lag(created_at) OVER w >= INTERVAL 24 HOUR, true) AS begins FROM written "
    "WINDOW w AS (PARTITION BY shard_id, term ORDER BY created_at)), "
    "lives AS (SELECT *, count_if(begins) OVER (PARTITION BY shard_id, term ORDER BY created_at RANGE UNBOUNDED PRECEDING) AS life "
    "FROM broken), "
    "last AS (SELECT * FROM lives QUALIFY life = max(life) OVER (PARTITION BY shard_id, term)) "
    "SELECT shard_id, term, CAST(sum(frequency_delta) AS BIGINT) AS frequency FROM last GROUP BY ALL "
    f"HAVING max(created_at) > {_NOW} - INTERVAL 24 HOUR"
)
# Starts of lives, each the first write a ttl or more after the one before.
_FIXED = (
    "SELECT u.shard_id, u.term, CAST(sum(frequency_delta) AS BIGINT) AS frequency FROM written u JOIN "
    "(SELECT shard_id, term, max(start) AS start FROM lives GROUP BY ALL) l "
    "ON u.shard_id = l.shard_id AND u.term = l.term AND u.created_at >= l.start "
    f"WHERE l.start > {_NOW} - INTERVAL {{ttl}} GROUP BY ALL"
)


def _fixed(ttl: str) -> str:
    lives = (
        "lives AS (SELECT shard_id, term, min(created_at) AS start FROM written GROUP BY ALL UNION ALL "
        "SELECT l.shard_id, l.term, min(u.created_at) FROM lives l JOIN written u ON u.shard_id = l.shard_id "
        f"AND u.term = l.term AND u.created_at >= l.start + INTERVAL {ttl} GROUP BY ALL)"
    )
    ctes = sql.with_(sql.UPDATES, _WRITTEN, lives).replace("WITH ", "WITH RECURSIVE ", 1)
    return ctes + _FIXED.format(ttl=ttl)


ORACLES = {
    "src04_scan_terms": _STORED + "SELECT * FROM stored WHERE shard_id = 0",
    "src05_scan_counters": sql.with_(*sql.COUNTERS) + "SELECT * FROM counters WHERE shard_id = 1",
    "src07_terms_round_trip": _STORED + "SELECT * FROM stored",
    "src11_publish_term_updates": _STORED
    + "SELECT shard_id, term, frequency AS frequency_delta FROM stored",
    "trm01_term_counts": _STORED + "SELECT * FROM stored",
    "trm02_apply_increments": sql.with_(*_EVENTS, _SUMMED) + "SELECT * FROM summed",
    "trm03_update_frequency": sql.with_(*_EVENTS, _SUMMED) + "SELECT * FROM summed WHERE frequency > 0",
    "trm03_visible_frequency": sql.with_(*_EVENTS, _SUMMED)
    + "SELECT shard_id, term, greatest(frequency, 0) AS frequency FROM summed",
    "trm04_remove_terms": sql.with_(*_BOTH)
    + "SELECT s.* FROM stored s ANTI JOIN bench_terms USING (shard_id, term) "
    "UNION ALL SELECT shard_id, term, 0 FROM bench_terms",
    "trm04_live_terms": sql.with_(*sql.COUNTERS) + "SELECT * FROM counters WHERE frequency > 0",
    "trm05_expire_terms": sql.with_(sql.UPDATES, _WRITTEN).rstrip() + ", " + _RENEWED,
    "trm05_expire_terms_fixed": _fixed("29 DAY"),
    "trm05_expire_terms_fixed_short": _fixed("4 DAY"),
    "trm06_term_frequency": sql.with_(*sql.STORED, sql.PREFIXES)
    + f"SELECT {sql.shard('prefix', 2)} AS shard_id, prefix AS term, coalesce(frequency, 0) AS frequency "
    "FROM prefixes LEFT JOIN stored ON term = prefix WHERE prefix <> ''",
    "trm07_suggest": sql.with_(*sql.STORED, sql.PREFIXES, _matches("stored"))
    + _top("matches", LIMIT, "prefix", "prefix, term, frequency"),
    "trm07_suggest_shard": sql.with_(*sql.STORED, sql.PREFIXES, _matches("stored"))
    + _top("matches", LIMIT, "prefix, shard_id", "prefix, shard_id, term, frequency"),
    "trm07_suggest_popular": _STORED
    + f"SELECT '' AS prefix, term, frequency, row_number() OVER ({_ORDER}) AS rank FROM stored {_ORDER} LIMIT {LIMIT}",
    "trm08_popular_terms": _STORED + f"SELECT term, frequency FROM stored {_ORDER} LIMIT 20",
    "trm09_merge_suggestions": sql.with_(
        *_BOTH,
        sql.PREFIXES,
        "everything AS (SELECT * FROM counters UNION ALL SELECT * FROM stored)",
        _matches("everything"),
        "lists AS (" + _top("matches", 2 * LIMIT, "prefix, shard_id", "prefix, shard_id, term, frequency") + ")",
        "merged AS (SELECT prefix, term, max(frequency) AS frequency FROM lists GROUP BY ALL)",
    )
    + _top("merged", LIMIT, "prefix", "prefix, term, frequency"),
    "trm09_typeahead": sql.with_(*sql.STORED, sql.PREFIXES, _matches("stored"))
    + _top("matches", LIMIT, "prefix", "prefix, term, frequency"),
    "trm11_build_prefix_table": sql.with_(
        *sql.STORED,
        "spelled AS (SELECT left(term, n) AS prefix, term, frequency FROM "
        "(SELECT *, unnest(range(length(term) + 1)) AS n FROM stored))",
    )
    + _top("spelled", 5, "prefix", "prefix, term, frequency"),
    **{
        name: sql.with_(*sql.STORED, sql.PREFIXES, _ODD, _matches("stored", "odd"))
        + _top("matches", limit, "prefix", "prefix, term, frequency")
        for name, limit in (
            ("trm07_suggest_odd_prefixes", LIMIT),
            ("trm09_typeahead_limit_80", 80),
            ("trm10_limit", 50),
            ("trm11_lookup_prefixes", LIMIT),
            ("trm11_lookup_beyond_the_table", LIMIT),
        )
    },
    "trm12_rebuild_terms": sql.with_(*_BOTH) + _SYNCED.format(stored="stored", counters="counters"),
    "trm13_sync_terms": sql.with_(*_BOTH) + _SYNCED.format(stored="stored", counters="counters"),
    "trm13_sync_counts": sql.with_(*_BOTH, _PAIRS)
    + "SELECT shard_id, count(*) FILTER (c > 0 AND s IS NULL) AS inserted, "
    "count(*) FILTER (c > 0 AND s IS NOT NULL) AS updated, "
    "count(*) FILTER (c <= 0 AND s IS NOT NULL) AS deleted FROM pairs GROUP BY ALL",
    "trm14_overlay_terms": sql.with_(*_EVENTS, _SUMMED)
    + _SYNCED.format(stored="event_terms", counters="summed"),
    "trm15_queue_updates": sql.with_(sql.UPDATES)
    + "SELECT term, frequency_delta, shard_id, batch_id, false AS processed FROM updates",
    "trm16_apply_batch": sql.with_(*_EVENTS, _PENDING) + _APPLIED,
    "trm16_apply_named_batch": sql.with_(*_EVENTS, _NAMED) + _APPLIED,
    "trm16_batch_counts": sql.with_(*_EVENTS, _PENDING)
    + "SELECT shard_id, count(*) AS terms_processed, count(frequency) AS terms_updated, "
    "count(*) FILTER (frequency IS NULL AND delta > 0) AS terms_inserted "
    "FROM deltas LEFT JOIN event_terms USING (shard_id, term) GROUP BY ALL",
    "trm17_mark_processed": sql.with_(sql.UPDATES)
    + "SELECT shard_id, batch_id, processed OR (batch_id = '2024-01-21' AND shard_id = 1) AS processed, "
    "count(*) AS n FROM updates GROUP BY ALL",
    "trm18_cleanup_buffer": sql.with_(sql.UPDATES)
    + "SELECT term, frequency_delta, shard_id, batch_id, processed FROM updates "
    "WHERE NOT (processed AND created_at < TIMESTAMP '2024-01-20' - INTERVAL 36 HOUR)",
    "trm18_cleanup_count": sql.with_(sql.UPDATES)
    + "SELECT count(*) AS deleted_count FROM updates "
    "WHERE processed AND created_at < TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR",
    "trm19_term_stats_summary": _STORED
    + "SELECT CAST(i AS INTEGER) AS shard_id, count(term) AS terms_in_db, "
    "coalesce(round(avg(frequency), 6), 0) AS avg_frequency, coalesce(max(frequency), 0) AS max_frequency, "
    "coalesce(min(frequency), 0) AS min_frequency FROM range(3) r(i) LEFT JOIN stored ON shard_id = i GROUP BY i",
    "trm20_sync_report": sql.with_(*_BOTH, _PAIRS)
    + "SELECT shard_id, count(c) AS counter_terms, count(s) AS stored_terms, "
    "count(*) FILTER (c IS DISTINCT FROM s) AS differing_terms FROM pairs GROUP BY ALL",
    "trm20_top_counters": sql.with_(*sql.COUNTERS)
    + _top("counters", 10, "shard_id", "shard_id, term, frequency"),
    "trm21_assign_term_shard": "SELECT term, "
    + sql.shard("lower(term)", 2)
    + " AS shard_id FROM (SELECT DISTINCT unnest(string_split_regex(text, '\\s+')) AS term FROM conversations)",
}

_REVIEWED = (sql.DOCS, sql.MARKS, sql.REVIEWED, "toxic AS (SELECT doc_id FROM marks WHERE toxic = 1)")
_RETITLED = "SELECT title, content FROM reviewed WHERE doc_id NOT IN (SELECT doc_id FROM toxic)"
ORACLES["trm01_term_counts_by_changes"] = (
    sql.with_(
        *_REVIEWED,
        f"after AS ({_RETITLED} UNION ALL SELECT title, content FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM marks))",
        sql.term_counts("after", "counted"),
    )
    + "SELECT * FROM counted"
)
ORACLES["trm01_term_counts_by_events"] = (
    sql.with_(*_REVIEWED, f"added AS (SELECT title, content FROM docs UNION ALL {_RETITLED})", sql.term_counts("added", "counted"))
    + "SELECT * FROM counted"
)
ORACLES["trm11_update_prefix_table"] = sql.with_(
    *_BOTH,
    f"synced AS ({_SYNCED.format(stored='stored', counters='counters')})",
    "spelled AS (SELECT left(term, n) AS prefix, term, frequency FROM "
    "(SELECT *, unnest(range(length(term) + 1)) AS n FROM synced))",
) + _top("spelled", 5, "prefix", "prefix, term, frequency")
