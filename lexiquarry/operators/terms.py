"""Term counters, their stored table, the update buffer and typeahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiquarry.functions.hashing import TERM_SHARDS, shard_of
from lexiquarry.functions.text import WHITE_SPACE, full_text, normalize_term, typeahead_tokens
from lexiquarry.operators.ranking import top_rows
from lexiquarry.session import lookup_side, settle

KEY = ["shard_id", "term"]

# Page limits of the services, how much of a shard's list the merge asks for, the
# life of a counter and of a processed buffer row, and the size of the counter
# report.
MAX_SUGGESTIONS = 50
MAX_POPULAR = 100
DEFAULT_SUGGESTIONS = 10
DEFAULT_POPULAR = 20
COUNTER_LIFE = "24 hours"
BUFFER_LIFE = "1 hour"
REPORT_TERMS = 10


def clamp(limit: int, maximum: int) -> int:
    """A limit as the services cut it; the operators here never cut one by themselves."""
    return min(limit, maximum)


def checked(limit: int, maximum: int | None) -> int:
    if maximum is not None and limit > maximum:
        raise ValueError(f"limit {limit} is above the maximum of {maximum}")
    return limit


def _normalized(df: DataFrame, column: str = "term") -> DataFrame:
    return df.withColumn(column, normalize_term(column)).where(F.col(column) != "")


def assign_term_shard(df: DataFrame, shards: int = TERM_SHARDS) -> DataFrame:
    return df.withColumn("shard_id", shard_of(F.lower("term"), shards))


def scan_terms(terms: DataFrame, shard_id: int) -> DataFrame:
    """Terms of a shard, most frequent first."""
    return terms.where(F.col("shard_id") == shard_id).orderBy(F.desc("frequency"), "term")


def scan_counters(counters: DataFrame, shard_id: int) -> DataFrame:
    """All counters of a shard, zero ones included."""
    return counters.where(F.col("shard_id") == shard_id)


def term_counts(docs: DataFrame, shards: int = TERM_SHARDS) -> DataFrame:
    """How often each suggestion term occurs in the documents.

    Counted per term and only then given a shard, so the hash is taken once per
    term. Counts are combined before the shuffle.
    """
    tokens = docs.select(F.explode(typeahead_tokens(full_text())).alias("term"))
    counts = tokens.groupBy("term").agg(F.count("*").alias("frequency"))
    return assign_term_shard(counts, shards).select("shard_id", "term", "frequency")


def term_changes(changes: DataFrame, mode: str = "snapshot", shards: int = TERM_SHARDS) -> DataFrame:
    """By how much term counts move when documents change: (shard_id, term, frequency_delta).

    `changes` has the versions of documents that come (column `change` 1) and go
    (-1). In mode "snapshot" an old version's terms are taken back, so counts
    stay those of the table as it is; in mode "events" versions only add, and a
    deletion takes nothing away.
    """
    if mode not in ("snapshot", "events"):
        raise ValueError(f"mode must be 'snapshot' or 'events', not {mode!r}")
    if mode == "events":
        changes = changes.where("change > 0")
    tokens = changes.select(F.explode(typeahead_tokens(full_text())).alias("term"), F.col("change").cast("bigint").alias("change"))
    moved = tokens.groupBy("term").agg(F.sum("change").alias("frequency_delta")).where("frequency_delta <> 0")
    return assign_term_shard(moved, shards).select(*KEY, "frequency_delta")


def apply_increments(counters: DataFrame, updates: DataFrame) -> DataFrame:
    """Counters after adding the deltas; any sign, in any order."""
    deltas = _normalized(updates).select(*KEY, F.col("frequency_delta").alias("frequency"))
    return (
        counters.select(*KEY, "frequency")
        .unionByName(deltas)
        .groupBy(*KEY)
        .agg(F.sum("frequency").alias("frequency"))
    )


def visible_frequency(frequency="frequency") -> Column:
    """A counter as shown: never below zero."""
    return F.greatest(F.lit(0).cast("bigint"), frequency)


def update_frequency(counters: DataFrame, deltas: DataFrame) -> DataFrame:
    """Terms after signed deltas; those at zero or below are gone."""
    return apply_increments(counters, deltas).where("frequency > 0")


def remove_terms(counters: DataFrame, terms: DataFrame) -> DataFrame:
    """Counters with the listed terms set to zero, as tombstones for the next sync."""
    gone = lookup_side(_normalized(terms).select(*KEY).distinct())
    kept = counters.select(*KEY, "frequency").join(gone, KEY, "left_anti")
    return kept.unionByName(gone.withColumn("frequency", F.lit(0).cast("bigint")))


def live_terms(counters: DataFrame) -> DataFrame:
    return counters.where("frequency > 0")


def _folded(updates: DataFrame, seconds: int) -> DataFrame:
    """Writes of a term within one stretch of the ttl's length as one row: first and last write, sum.

    There is no break of the ttl's length within a stretch. Sums are combined
    before the shuffle, so a hot term is as many rows as it has stretches.
    """
    at = F.unix_micros("created_at")
    stretch = F.floor(at / F.lit(seconds * 1_000_000)).alias("stretch")
    return updates.groupBy(*KEY, stretch).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.sum("frequency_delta").alias("delta")
    )


def _last_life(folded: DataFrame, micros: int) -> DataFrame:
    """The first write after a term's last break of at least the ttl, or its first of all, as `since`."""
    order = Window.partitionBy(*KEY).orderBy("stretch")
    broken = F.col("first") - F.lag("last").over(order) >= micros
    begins = folded.withColumn("begin", F.when(F.coalesce(broken, F.lit(True)), F.col("first")))
    return begins.groupBy(*KEY).agg(F.max("begin").alias("since"))


def expire_terms(updates: DataFrame, now: Column, ttl: str = COUNTER_LIFE, renew: bool = True) -> DataFrame:
    """Counters of an update log that are alive at `now`; writes after it don't count.

    A counter that has expired starts again at zero with the next write, so a
    term's writes fall into lives and only the last one counts. With `renew`
    every write starts the ttl again: a life ends with a break of at least the
    ttl. Without, only a life's first write does: the life ends a ttl later,
    and the next write begins another. That is followed stretch by stretch, as
    many jobs as there are ttls in the writes since the last break; each reads
    its stretch only.
    """
    interval = F.expr(f"INTERVAL {ttl}")
    spark = updates.sparkSession
    length = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + interval)).first()[0]
    seconds = length // 1_000_000
    end = F.unix_micros(now)
    written = _normalized(updates).where(F.unix_micros("created_at") <= end)
    folded = settle(_folded(written, seconds), "folded")
    since = settle(_last_life(folded, length), "since")
    if renew:
        lives = folded.join(since, KEY).where(F.col("first") >= F.col("since")).groupBy(*KEY)
        totals = lives.agg(F.sum("delta").alias("frequency"), F.max("last").alias("at"))
        return totals.where(F.col("at") > end - length).select(*KEY, "frequency")
    at = F.unix_micros("created_at")
    stretch = F.floor(at / F.lit(length))
    spread = folded.join(since, KEY).where(F.col("first") >= F.col("since")).agg(F.min("stretch"), F.max("stretch"))
    low, high = spread.first()
    for number in range((low or 0) + 1, (high or 0) + 1):
        # At most one life begins in a stretch: the first write a ttl or more after the last began.
        own = written.where(stretch == number).select(*KEY, at.alias("at")).join(since, KEY)
        begun = own.where(F.col("at") >= F.col("since") + length).groupBy(*KEY).agg(F.min("at").alias("begun"))
        since = settle(
            since.join(begun, KEY, "left").select(*KEY, F.coalesce("begun", "since").alias("since")), "since"
        )
    alive = since.where(F.col("since") > end - length)
    return (
        written.join(alive, KEY)
        .where(at >= F.col("since"))
        .groupBy(*KEY)
        .agg(F.sum("frequency_delta").alias("frequency"))
    )


def term_frequency(counters: DataFrame, asked: DataFrame) -> DataFrame:
    """Frequency of each asked term, zero when there is no counter."""
    wanted = assign_term_shard(_normalized(asked).select("term").distinct())
    wanted = lookup_side(wanted)
    found = counters.join(wanted, KEY, "left_semi").select(*KEY, "frequency")
    return wanted.join(found, KEY, "left").select(
        *KEY, F.coalesce("frequency", F.lit(0).cast("bigint")).alias("frequency")
    )


def _order() -> list[Column]:
    return [F.desc("frequency"), F.asc("term")]


def suggest_one(
    terms: DataFrame, prefix: str, limit: int = DEFAULT_SUGGESTIONS, maximum: int | None = None
) -> DataFrame:
    """Most frequent terms that start with a prefix; the prefix filter reaches the scan.

    Without a prefix these are the popular terms.
    """
    terms = terms.select("term", "frequency")
    cleaned = prefix.lower().strip(WHITE_SPACE)
    if cleaned:
        terms = terms.where(F.col("term").startswith(cleaned))
    return terms.orderBy(*_order()).limit(checked(limit, maximum))


def suggest(
    terms: DataFrame,
    prefixes: DataFrame,
    limit: int = DEFAULT_SUGGESTIONS,
    per_shard: bool = False,
    maximum: int | None = None,
) -> DataFrame:
    """Most frequent terms for every prefix of a table; an empty prefix gives popular terms.

    Terms are spelled out into prefixes of the lengths that are asked for, and
    met by equality. That is a hash join, where a starts-with condition would
    compare every term with every prefix.
    """
    asked = lookup_side(prefixes.select(normalize_term("prefix").alias("prefix")).distinct())
    lengths = asked.agg(F.collect_set(F.length("prefix"))).scalar()
    spelled = terms.select(
        "*", F.explode(F.array_intersect(F.sequence(F.lit(0), F.length("term")), lengths)).alias("_n")
    ).withColumn("prefix", F.substr("term", F.lit(1), F.col("_n")))
    found = spelled.drop("_n").join(asked, "prefix")
    keys = ["prefix", "shard_id"] if per_shard else ["prefix"]
    top = top_rows(found, keys, _order(), checked(limit, maximum), salt="term")
    return top.select(*keys, "term", "frequency", "rank")


def merge_suggestions(per_shard: DataFrame, limit: int = DEFAULT_SUGGESTIONS) -> DataFrame:
    """Lists of several shards as one: a term keeps its highest frequency."""
    merged = per_shard.groupBy("prefix", "term").agg(F.max("frequency").alias("frequency"))
    return top_rows(merged, ["prefix"], _order(), limit, salt="term")


def typeahead(
    terms: DataFrame, prefixes: DataFrame, limit: int = DEFAULT_SUGGESTIONS, maximum: int | None = None
) -> DataFrame:
    """Suggestions over all shards: each gives its best 2 * limit, which are merged.

    A term of the merged list is among the best `limit` of some shard.
    """
    return merge_suggestions(suggest(terms, prefixes, 2 * checked(limit, maximum), per_shard=True), limit)


def popular_terms(terms: DataFrame, limit: int = DEFAULT_POPULAR, maximum: int | None = None) -> DataFrame:
    best = terms.select("term", "frequency").orderBy(*_order())
    return best.limit(checked(limit, maximum))


def build_prefix_table(
    terms: DataFrame, k: int = DEFAULT_SUGGESTIONS, max_length: int | None = None
) -> DataFrame:
    """Every prefix, the empty one included, with its `k` most frequent terms.

    A `max_length` keeps the table small; `lookup_prefixes` then needs the terms
    for longer prefixes.
    """
    longest = F.length("term") if max_length is None else F.least(F.length("term"), F.lit(max_length))
    spelled = terms.select(
        "term", "frequency", F.explode(F.sequence(F.lit(0), longest)).alias("_n")
    ).select(F.substr("term", F.lit(1), F.col("_n")).alias("prefix"), "term", "frequency")
    return top_rows(spelled, ["prefix"], _order(), k, salt="term")


def update_prefix_table(
    table: DataFrame,
    terms: DataFrame,
    changed: DataFrame,
    k: int = DEFAULT_SUGGESTIONS,
    max_length: int | None = None,
) -> DataFrame:
    """The prefix table after the terms of `changed` came, went or moved; `terms` are all as they are now.

    Only prefixes of changed terms are worked out anew, from all terms that
    begin with them, so a term moves up where another falls out; the rows of all
    other prefixes stay. `k` and `max_length` are those the table was built with.
    """
    longest = F.length("term") if max_length is None else F.least(F.length("term"), F.lit(max_length))
    spelled = F.transform(F.sequence(F.lit(0), longest), lambda n: F.substr("term", F.lit(1), n))
    touched = lookup_side(changed.select(F.explode(spelled).alias("prefix")).distinct())
    again = terms.select("term", "frequency", F.explode(spelled).alias("prefix")).join(touched, "prefix")
    best = top_rows(again.select("prefix", "term", "frequency"), ["prefix"], _order(), k, salt="term")
    kept = table.join(touched, "prefix", "left_anti")
    return kept.unionByName(best.select(*kept.columns))


def lookup_prefixes(
    table: DataFrame,
    prefixes: DataFrame,
    terms: DataFrame | None = None,
    k: int = DEFAULT_SUGGESTIONS,
    max_length: int | None = None,
) -> DataFrame:
    """The table's rows of the asked prefixes.

    For a table built with a `max_length`, longer prefixes are answered from the terms.
    """
    asked = lookup_side(prefixes.select(normalize_term("prefix").alias("prefix")).distinct())
    found = table.join(asked, "prefix")
    if max_length is None:
        return found
    if terms is None:
        raise ValueError("prefixes longer than the table's need the terms")
    return found.unionByName(suggest(terms, asked.where(F.length("prefix") > max_length), k))


def _against_counters(terms: DataFrame, counters: DataFrame) -> DataFrame:
    stored = terms.select(*KEY, F.col("frequency").alias("_stored"))
    counted = counters.select(*KEY, F.col("frequency").alias("_counted"))
    return stored.join(counted, KEY, "full")


def sync_terms(terms: DataFrame, counters: DataFrame) -> DataFrame:
    """The stored table after a sync.

    A counter replaces the stored frequency, at zero or below it deletes the
    row; rows without a counter stay.
    """
    merged = _against_counters(terms, counters).select(
        *KEY, F.coalesce("_counted", "_stored").alias("frequency")
    )
    return merged.where(F.col("frequency") > 0)


def sync_counts(terms: DataFrame, counters: DataFrame) -> DataFrame:
    """How many rows a sync inserts, updates and deletes, per shard."""
    both = _against_counters(terms, counters)
    live, known = F.col("_counted") > 0, F.col("_stored").isNotNull()
    return both.groupBy("shard_id").agg(
        F.count_if(live & ~known).alias("inserted"),
        F.count_if(live & known).alias("updated"),
        F.count_if((F.col("_counted") <= 0) & known).alias("deleted"),
    )


def overlay_terms(snapshot: DataFrame, counters: DataFrame) -> DataFrame:
    """The view suggestions are served from: the snapshot under the counters."""
    return sync_terms(snapshot, counters)


def rebuild_terms(terms: DataFrame, counters: DataFrame) -> DataFrame:
    """The view made anew from the stored table; frequencies are replaced, never added."""
    fresh = _normalized(terms).groupBy(*KEY).agg(F.sum("frequency").alias("frequency"))
    return overlay_terms(fresh, counters)


def queue_updates(updates: DataFrame, now: Column, batch_id: Column | None = None) -> DataFrame:
    """Rows for the update buffer; rows without a batch id get a random one."""
    given = F.coalesce("batch_id", F.uuid()) if batch_id is None else batch_id
    return updates.select(
        "term",
        "frequency_delta",
        "shard_id",
        given.alias("batch_id"),
        now.alias("created_at"),
        F.lit(False).alias("processed"),
    )


def _of_batch(batch_id: str | None, shard_id: int | None) -> Column:
    chosen = F.lit(True)
    if batch_id is not None:
        chosen = chosen & (F.col("batch_id") == batch_id)
    if shard_id is not None:
        chosen = chosen & (F.col("shard_id") == shard_id)
    return chosen


def _with_deltas(terms, buffer, batch_id, shard_id) -> DataFrame:
    deltas = (
        buffer.where(~F.col("processed") & _of_batch(batch_id, shard_id))
        .groupBy(*KEY)
        .agg(F.sum("frequency_delta").alias("_delta"))
    )
    stored = terms.select(*KEY, F.col("frequency").alias("_stored"))
    return stored.join(deltas, KEY, "full")


def apply_batch(
    terms: DataFrame, buffer: DataFrame, batch_id: str | None = None, shard_id: int | None = None
) -> DataFrame:
    """The stored table after the unprocessed rows of a batch (of all, when none is named).

    Known terms move by the summed delta and go at zero or below; unknown ones
    are inserted only with a positive sum.
    """
    zero = F.lit(0).cast("bigint")
    moved = _with_deltas(terms, buffer, batch_id, shard_id).select(
        *KEY,
        F.greatest(zero, F.coalesce("_stored", zero) + F.coalesce("_delta", zero)).alias("frequency"),
    )
    return moved.where("frequency > 0")


def batch_counts(
    terms: DataFrame, buffer: DataFrame, batch_id: str | None = None, shard_id: int | None = None
) -> DataFrame:
    """Terms a batch processes, updates and inserts; updated ones count also when they go."""
    both = _with_deltas(terms, buffer, batch_id, shard_id).where("_delta is not null")
    known = F.col("_stored").isNotNull()
    return both.groupBy("shard_id").agg(
        F.count("*").alias("terms_processed"),
        F.count_if(known).alias("terms_updated"),
        F.count_if(~known & (F.col("_delta") > 0)).alias("terms_inserted"),
    )


def mark_processed(buffer: DataFrame, batch_id: str | None = None, shard_id: int | None = None) -> DataFrame:
    done = F.col("processed") | _of_batch(batch_id, shard_id)
    return buffer.withColumn("processed", done)


def cleanup_buffer(buffer: DataFrame, now: Column, life: str = BUFFER_LIFE) -> DataFrame:
    """The buffer without processed rows older than `life`."""
    return buffer.where(~_outdated(now, life))


def cleanup_count(buffer: DataFrame, now: Column, life: str = BUFFER_LIFE) -> DataFrame:
    return buffer.agg(F.count_if(_outdated(now, life)).alias("deleted_count"))


def _outdated(now: Column, life: str) -> Column:
    return F.col("processed") & (F.col("created_at") < now - F.expr(f"INTERVAL {life}"))


def term_stats_summary(terms: DataFrame, shards: int = TERM_SHARDS) -> DataFrame:
    """Count, mean, highest and lowest frequency per shard; zeros for an empty one."""
    wanted = terms.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard_id"))
    found = terms.groupBy("shard_id").agg(
        F.count("*").alias("terms_in_db"),
        F.avg("frequency").alias("avg_frequency"),
        F.max("frequency").alias("max_frequency"),
        F.min("frequency").alias("min_frequency"),
    )
    zero = F.lit(0).cast("bigint")
    return wanted.join(found, "shard_id", "left").select(
        "shard_id",
        F.coalesce("terms_in_db", zero).alias("terms_in_db"),
        F.coalesce("avg_frequency", F.lit(0.0)).alias("avg_frequency"),
        F.coalesce("max_frequency", zero).alias("max_frequency"),
        F.coalesce("min_frequency", zero).alias("min_frequency"),
    )


def sync_report(counters: DataFrame, terms: DataFrame) -> DataFrame:
    """Per shard: counters, stored terms, and terms the two disagree on."""
    differs = ~F.col("_counted").eqNullSafe(F.col("_stored"))
    return (
        _against_counters(terms, counters)
        .groupBy("shard_id")
        .agg(
            F.count("_counted").alias("counter_terms"),
            F.count("_stored").alias("stored_terms"),
            F.count_if(differs).alias("differing_terms"),
        )
    )


def top_counters(counters: DataFrame, k: int = REPORT_TERMS) -> DataFrame:
    """The largest counters of each shard."""
    return top_rows(counters.select(*KEY, "frequency"), ["shard_id"], _order(), k, salt="term")
