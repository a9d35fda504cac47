"""TF-IDF search over the index, for one query or a table of them.

Ids are ranked first and document rows fetched last, so the wide document table
is only read for the hits that are returned.

Scores are summed in units of 1e-14, as whole numbers: the sum does not depend
on the order of its terms, so equal documents tie in every run and engine.
Ranking uses these; the score that is shown is rounded to six places.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.functions.hashing import document_bucket
from lexiquarry.functions.text import iso_timestamp, preprocess, snippet
from lexiquarry.operators.index import KEY, Index, corpus_size, postings, term_bucket
from lexiquarry.operators.ranking import top_rows
from lexiquarry.session import lookup_side, settle

# The page defaults.
DEFAULT_SIZE = 10
SNIPPET_CHARS = 500

UNITS = 1e14


def query_terms(queries: DataFrame, stem: bool = True) -> DataFrame:
    """Distinct terms of each query with their count in it."""
    terms = queries.select("query_id", F.explode(preprocess("query", stem=stem)).alias("term"))
    return terms.groupBy("query_id", "term").agg(F.count("*").alias("query_tf"))


def candidates(index: Index, terms: DataFrame) -> DataFrame:
    """Postings of the query terms: every document with at least one of them.

    The query side is broadcast when counted small, so the postings are not
    shuffled; a larger one is joined by a shuffle on the term, whose hot
    partitions adaptive execution splits. The postings are read by document
    where the index has them so: what is grouped by document then is grouped
    where it lies, in tasks of a bounded number of documents.
    """
    return _matching(index, lookup_side(terms))


def _matching(index: Index, terms: DataFrame) -> DataFrame:
    keys = [k for k in ("shard_id", "term") if k in terms.columns]
    if index.doc_terms is None:
        return index.postings.join(terms, keys)
    entries = postings(index.doc_terms)
    if "term_bucket" in index.postings.columns:
        entries = entries.withColumn("term_bucket", term_bucket(index.buckets))
    return entries.select(*index.postings.columns).join(terms, keys)


def term_weights(index: Index, terms: DataFrame, stats: str = "global") -> DataFrame:
    """Query terms that occur in the corpus, with `weight` = ln(N / df) * query_tf.

    The terms are joined to the statistics before anything is aggregated, so
    only the query vocabulary is. N and df are of the shard or of the corpus.
    """
    known = index.term_stats.join(terms, "term")
    if stats == "shard":
        # One row per shard.
        sizes = F.broadcast(corpus_size(index.doc_stats))
        known = known.join(sizes, "shard_id")
        keys = ["query_id", "shard_id", "term"]
    elif stats == "global":
        known = known.groupBy("query_id", "term", "query_tf").agg(F.sum("df").alias("df"))
        known = known.withColumn("n_docs", index.doc_stats.agg(F.count("*")).scalar())
        keys = ["query_id", "term"]
    else:
        raise ValueError(f"stats must be 'global' or 'shard', not {stats!r}")
    weight = F.log(F.col("n_docs") / F.col("df")) * F.col("query_tf")
    return known.select(*keys, weight.alias("weight"))


def units(weight: Column | str = "weight") -> Column:
    """What a posting adds to a score, in whole units."""
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.round(F.col("tf") / F.col("doc_len") * weight * UNITS).cast("bigint")


def _scores(matching: DataFrame, keys: tuple[str, ...] = ("query_id",)) -> DataFrame:
    return matching.groupBy(*keys, *KEY).agg((F.sum(units()) / UNITS).alias("score"))


def tfidf(index: Index, terms: DataFrame, stats: str = "global") -> DataFrame:
    """Score of every candidate; a score of zero stays."""
    return _scores(candidates(index, term_weights(index, settle(terms), stats)))


def shown_score(score: str = "score") -> Column:
    return F.round(score, 6).alias("score")


def top_k(scores: DataFrame, k: int, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Best k per query with their rank; equal scores are ordered by document id, then shard."""
    order = [F.desc("score"), F.asc("doc_id")] + ([F.asc("shard_id")] if "shard_id" in scores.columns else [])
    return top_rows(scores, list(by), order, k, salt="doc_id")


def assemble_hits(ranked: DataFrame, docs: DataFrame, snippet_chars: int = SNIPPET_CHARS) -> DataFrame:
    """Add the document fields; hits without a document are dropped.

    The hits are the small side: when counted so they are broadcast and the
    document table is scanned without a shuffle.
    """
    return _with_fields(lookup_side(ranked), docs, snippet_chars)


def _with_fields(ranked: DataFrame, docs: DataFrame, snippet_chars: int = SNIPPET_CHARS) -> DataFrame:
    names = ["shard_id", "doc_id", "title", "content", "source", "metadata", "created_at"]
    keys = list(KEY)
    if "doc_bucket" in docs.columns:
        # The table is stored by buckets of the id; only those of the hits are opened.
        keys.append("doc_bucket")
        ranked = ranked.withColumn("doc_bucket", document_bucket("doc_id"))
    fields = docs.select(*dict.fromkeys([*names, *keys]))
    # After the join, so that only texts of hits are cut.
    return fields.join(ranked, keys).drop("doc_bucket").withColumns(
        {"content": snippet("content", snippet_chars), "created_at": iso_timestamp("created_at")}
    )


def paginate(ranked: DataFrame, offset: int = 0, size: int = DEFAULT_SIZE) -> DataFrame:
    """Hits ranked offset + 1 to offset + size."""
    return ranked.where((F.col("rank") > offset) & (F.col("rank") <= offset + size))


def total_hits(scores: DataFrame, cap: int | None = None) -> DataFrame:
    """Matching documents per query, at most `cap` when one is given."""
    n = F.count("*")
    return scores.groupBy("query_id").agg((F.least(n, F.lit(cap)) if cap is not None else n).alias("total"))


def missing_documents(index: Index, docs: DataFrame) -> DataFrame:
    """Keys in the index that the document table no longer has; reads keys only."""
    return index.doc_stats.select(*KEY).join(docs.select(*KEY), KEY, "left_anti")


def best_of_documents(doc_terms: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """The best k documents of each query, and no others, with their score.

    `weights` has query_id, term, weight, and shard_id if they differ by shard;
    with it, each shard gives its best k. All terms of a document are in its
    row and the stored table is known to be dealt by document, so the matches
    of a query and a document are summed where they lie, and a task sends the
    best k of each query: no match is shuffled as long as the weights can be
    broadcast. Beyond that bound the terms are shuffled to them.
    """
    by_shard = "shard_id" in weights.columns
    each = doc_terms.select("shard_id", "doc_id", "doc_len", F.inline("terms"))
    scores = _scores(each.join(lookup_side(weights), ["shard_id", "term"] if by_shard else ["term"]))
    return top_k(scores, k, ("query_id", "shard_id") if by_shard else ("query_id",)).drop("rank")


def search_batch(
    index: Index,
    docs: DataFrame,
    queries: DataFrame,
    size: int = DEFAULT_SIZE,
    offset: int = 0,
    stats: str = "global",
    stem: bool = True,
) -> DataFrame:
    """One page of hits for every query of a table.

    `stats="global"` ranks with corpus-wide statistics. `stats="shard"` scores
    every shard with its own and merges them, each with as many as the page can
    reach. Documents that are gone from the table are left out before anything
    is ranked, so pages are full as long as there are hits. Queries without a
    known term have no rows. Query terms, weights and hits are worked out when
    this is called; the rows of the page when they are read.
    """
    weights = settle(term_weights(index, settle(query_terms(queries, stem)), stats))
    gone = settle(missing_documents(index, docs))
    if index.doc_terms is not None:
        best = best_of_documents(index.doc_terms.join(gone, KEY, "left_anti"), weights, offset + size)
    else:
        best = _scores(_matching(index, weights)).join(gone, KEY, "left_anti")
    page = paginate(top_k(best, offset + size), offset, size)
    hits = _with_fields(settle(page).where(F.col("rank") <= offset + size), docs)
    return hits.withColumn("score", shown_score())


def _constant(spark, *columns: Column):
    """Values of constant columns, worked out without a job."""
    return spark.sql("VALUES (1)").select(*columns).first()


def _rows(spark, schema: str, rows: list[tuple]) -> DataFrame:
    """A few given rows as a frame of literals, which needs no Python on the executors."""
    names = [part.split()[0] for part in schema.split(", ")]
    one = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows))
    typed = one.cast(f"array<struct<{', '.join(p.replace(' ', ':') for p in schema.split(', '))}>>")
    return spark.sql("VALUES (1)").select(F.inline(typed))


def one_query_scores(index: Index, weights: dict, by_shard: bool) -> DataFrame:
    """Scores of all documents that have a term of one query.

    The terms are literals, so the stored index is pruned to their buckets and
    row groups; the weights are as many rows as the query has terms.
    """
    spark = index.postings.sparkSession
    keys = ["shard_id", "term"] if by_shard else ["term"]
    words = sorted({w[-1] for w in weights})
    entries = index.postings.where(F.col("term").isin(words))
    if index.buckets:
        numbers = _constant(spark, F.array(*(term_bucket(index.buckets, F.lit(w)) for w in words)))[0]
        entries = entries.where(F.col("term_bucket").isin(sorted(set(numbers))))
    schema = ("shard_id int, " if by_shard else "") + "term string, weight double"
    side = _rows(spark, schema, [(*w, x) for w, x in weights.items()])
    return _scores(entries.join(F.broadcast(side), keys), ())


def query_weights(index: Index, query: str, stats: str, stem: bool) -> dict:
    """ln(N / df) * query_tf of one query's known terms, by term or by shard and term."""
    spark = index.postings.sparkSession
    asked = Counter(_constant(spark, preprocess(F.lit(query), stem=stem))[0])
    if not asked:
        return {}
    # Document frequencies and corpus sizes (without a term) in one go.
    found = index.term_stats.where(F.col("term").isin(sorted(asked))).select("shard_id", "term", "df")
    sizes = corpus_size(index.doc_stats).select("shard_id", F.lit(None).cast("string").alias("term"), F.col("n_docs").alias("df"))
    rows = found.unionByName(sizes).collect()
    known = [r for r in rows if r["term"] is not None]
    sizes = {r["shard_id"]: r["df"] for r in rows if r["term"] is None}
    if stats == "shard":
        return {
            (r["shard_id"], r["term"]): math.log(sizes[r["shard_id"]] / r["df"]) * asked[r["term"]] for r in known
        }
    if stats != "global":
        raise ValueError(f"stats must be 'global' or 'shard', not {stats!r}")
    df: Counter = Counter()
    for r in known:
        df[r["term"]] += r["df"]
    return {(term,): math.log(sum(sizes.values()) / n) * asked[term] for term, n in df.items()}


def search(
    index: Index,
    docs: DataFrame,
    query: str,
    size: int = DEFAULT_SIZE,
    offset: int = 0,
    stats: str = "global",
    stem: bool = True,
) -> DataFrame:
    """One page of hits for one query, best first.

    The best ids are looked up among the documents as literals; if some are
    gone, all scores are met with the keys of the table first. Either way no
    more rows come to the driver than the page reaches down to.
    """
    if not query:
        raise ValueError("Query is required")
    if stats not in ("global", "shard"):
        raise ValueError(f"stats must be 'global' or 'shard', not {stats!r}")
    spark = docs.sparkSession
    weights = query_weights(index, query, stats, stem)
    wanted = offset + size
    page: list[tuple] = []
    if weights:
        scores = one_query_scores(index, weights, stats == "shard")
        order = [F.desc("score"), F.asc("doc_id"), F.asc("shard_id")]
        best = scores.orderBy(*order).limit(wanted).collect()
        there = {tuple(r) for r in _named(docs, best).select(*KEY).collect()} if best else set()
        left = [r for r in best if (r["shard_id"], r["doc_id"]) in there]
        if len(left) < len(best):
            left = scores.join(docs.select(*KEY), KEY, "left_semi").orderBy(*order).limit(wanted).collect()
        page = [(r["shard_id"], r["doc_id"], n + 1, r["score"]) for n, r in enumerate(left)][offset:]
    ranked = _rows(spark, "shard_id int, doc_id string, rank bigint, score double", page)
    named = _named(docs, [{"shard_id": r[0], "doc_id": r[1]} for r in page])
    # A page of rows, by the caller's size.
    hits = _with_fields(F.broadcast(ranked), named)
    return hits.withColumn("score", shown_score()).orderBy("rank")


def _named(docs: DataFrame, rows: list) -> DataFrame:
    """The documents of a page's keys, which reach the scan as literals."""
    ids = sorted({r["doc_id"] for r in rows})
    found = docs.where(F.col("doc_id").isin(ids) & F.col("shard_id").isin(sorted({r["shard_id"] for r in rows})))
    if "doc_bucket" in docs.columns and ids:
        numbers = _constant(docs.sparkSession, F.array(*(document_bucket(F.lit(i)) for i in ids)))[0]
        found = found.where(F.col("doc_bucket").isin(sorted(set(numbers))))
    return found
