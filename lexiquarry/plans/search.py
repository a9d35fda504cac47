"""Search over the corpus with the benchmark texts as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiquarry.functions.text import iso_timestamp, snippet
from lexiquarry.operators import search as ops
from lexiquarry.plans import sql, views
from lexiquarry.session import settle

SIZE = 10


def _parts(spark, sf, stem=False):
    index = views.stored_index(spark, sf, stem)
    return index, ops.query_terms(views.queries(spark, sf), stem)


def _shown(hits):
    """All fields of hits; metadata as its JSON text."""
    fields = ("query_id", "rank", "shard_id", "doc_id", "title", "content", "source", "created_at")
    return hits.select(*fields, ops.shown_score(), F.to_json("metadata").alias("metadata"))


def _rounded(scores):
    return scores.withColumn("score", ops.shown_score())


def sch01_candidates(spark, sf):
    index, terms = _parts(spark, sf)
    return ops.candidates(index, terms).select("query_id", "shard_id", "doc_id").distinct()


def sch02_tfidf(spark, sf):
    return _rounded(ops.tfidf(*_parts(spark, sf)))


def sch02_tfidf_shard(spark, sf):
    return _rounded(ops.tfidf(*_parts(spark, sf), stats="shard"))


def sch03_top_k(spark, sf):
    return _rounded(ops.top_k(ops.tfidf(*_parts(spark, sf)), SIZE))


def sch03_top_k_deep(spark, sf):
    """More rows per query than are pruned before the shuffle by themselves."""
    return _rounded(ops.top_k(ops.tfidf(*_parts(spark, sf)), 5000))


def sch04_assemble_hits(spark, sf):
    best = ops.top_k(ops.tfidf(*_parts(spark, sf)), SIZE)
    return _shown(ops.assemble_hits(best, views.kept(spark, sf)))


def sch05_snippet(spark, sf):
    return views.documents(spark, sf).select("doc_id", snippet("content").alias("content"))


def sch06_paginate(spark, sf):
    scores = ops.tfidf(*_parts(spark, sf))
    return _rounded(ops.paginate(ops.top_k(scores, 20 + SIZE), offset=20, size=SIZE))


def sch07_total_hits(spark, sf):
    scores = settle(ops.tfidf(*_parts(spark, sf)))
    capped = ops.total_hits(scores, cap=60).withColumnRenamed("total", "capped")
    return ops.total_hits(scores).join(capped, "query_id")


def sch08_search_shard(spark, sf):
    index = views.stored_index(spark, sf, stem=False)
    hits = ops.search_batch(
        index, views.kept(spark, sf), views.queries(spark, sf), SIZE, stats="shard", stem=False
    )
    return _shown(hits)


def sch08_search_shard_page7(spark, sf):
    """A page far beyond what two pages of each shard hold."""
    index = views.stored_index(spark, sf, stem=False)
    hits = ops.search_batch(
        index, views.kept(spark, sf), views.queries(spark, sf), SIZE, offset=6 * SIZE, stats="shard", stem=False
    )
    return _shown(hits)


def sch09_search_most_missing(spark, sf):
    """Most documents are gone from the table, among them the best hits of every query."""
    index = views.stored_index(spark, sf, stem=False)
    left = views.documents(spark, sf).where("source = 'src3'")
    return _shown(ops.search_batch(index, left, views.queries(spark, sf), SIZE, stem=False))


def sch11_stop_words_only(spark, sf):
    """Queries without any search word among those that have some."""
    index = views.stored_index(spark, sf, stem=False)
    asked = views.queries(spark, sf)
    stop = asked.select((-F.col("query_id") - 1).alias("query_id"), F.lit("the and of, it to").alias("query"))
    docs = views.documents(spark, sf)
    return _shown(ops.search_batch(index, docs, asked.unionByName(stop), SIZE, stem=False))


def sch12_search_long_query(spark, sf):
    """All benchmark texts as one query of some thousand terms."""
    index = views.stored_index(spark, sf, stem=False)
    texts = F.array_join(F.array_sort(F.collect_list("query")), " ")
    asked = views.queries(spark, sf).agg(F.lit(0).cast("bigint").alias("query_id"), texts.alias("query"))
    return _shown(ops.search_batch(index, views.documents(spark, sf), asked, SIZE, stem=False))


def sch09_search_global(spark, sf):
    index = views.stored_index(spark, sf, stem=False)
    hits = ops.search_batch(
        index, views.kept(spark, sf), views.queries(spark, sf), SIZE, offset=5, stem=False
    )
    return _shown(hits)


def sch10_iso_timestamp(spark, sf):
    rows = views.table(spark, sf, "events")
    return rows.select("event_id", iso_timestamp(F.col("ts").cast("timestamp")).alias("ts"))


def sch12_search_batch(spark, sf):
    """The flagship: every query against the whole corpus, best ten hits each."""
    index = views.stored_index(spark, sf, stem=False)
    docs = views.documents(spark, sf)
    return _shown(ops.search_batch(index, docs, views.queries(spark, sf), SIZE, stem=False))


def sch12_search_batch_stemmed(spark, sf):
    index = views.stored_index(spark, sf, stem=True)
    docs = views.documents(spark, sf)
    return _shown(ops.search_batch(index, docs, views.queries(spark, sf), SIZE))


QUERIES = {
    f.__name__: f
    for f in (
        sch01_candidates,
        sch02_tfidf,
        sch02_tfidf_shard,
        sch03_top_k,
        sch03_top_k_deep,
        sch04_assemble_hits,
        sch05_snippet,
        sch06_paginate,
        sch07_total_hits,
        sch08_search_shard,
        sch08_search_shard_page7,
        sch09_search_most_missing,
        sch11_stop_words_only,
        sch12_search_long_query,
        sch09_search_global,
        sch10_iso_timestamp,
        sch12_search_batch,
        sch12_search_batch_stemmed,
    )
}

_QUERY_WORDS = (
    f"asked AS (SELECT * FROM (SELECT query_id, unnest({sql.tokens('query')}) AS term FROM queries) "
    f"WHERE {sql.search_word()})"
)


def _index(stem: bool) -> tuple[str, ...]:
    if not stem:
        return (
            sql.DOCS,
            sql.words("docs"),
            sql.QUERIES,
            _QUERY_WORDS,
            *sql.index("docs"),
            "query_terms AS (SELECT query_id, term, count(*) AS query_tf FROM asked GROUP BY ALL)",
        )
    return (
        sql.DOCS,
        sql.words("docs"),
        sql.QUERIES,
        _QUERY_WORDS,
        "vocabulary AS (SELECT term FROM words UNION SELECT term FROM asked)",
        *sql.stems("vocabulary"),
        "stemmed AS (SELECT shard_id, doc_id, stem AS term FROM words JOIN stems USING (term))",
        *sql.index("docs", "stemmed"),
        "query_terms AS (SELECT query_id, stem AS term, count(*) AS query_tf FROM asked JOIN stems USING (term) GROUP BY ALL)",
    )


_SCORE = "CAST(sum(CAST(round(tf / doc_len * (ln(n / df) * query_tf) * 1e14) AS BIGINT)) AS BIGINT) / 1e14 AS score"
_SHOWN = "* REPLACE (round(score, 6) AS score)"
_SCORES = {
    "global": (
        "corpus_df AS (SELECT term, sum(df) AS df FROM term_stats GROUP BY ALL)",
        "corpus AS (SELECT count(*) AS n FROM docs)",
        f"scores AS (SELECT query_id, p.shard_id, p.doc_id, {_SCORE} FROM query_terms "
        "JOIN postings p USING (term) JOIN corpus_df USING (term) "
        "JOIN doc_stats s ON s.doc_id = p.doc_id CROSS JOIN corpus GROUP BY ALL)",
    ),
    "shard": (
        "corpus AS (SELECT shard_id, count(*) AS n FROM docs GROUP BY ALL)",
        f"scores AS (SELECT query_id, p.shard_id, p.doc_id, {_SCORE} FROM query_terms "
        "JOIN postings p USING (term) JOIN term_stats USING (shard_id, term) "
        "JOIN doc_stats s ON s.doc_id = p.doc_id JOIN corpus USING (shard_id) GROUP BY ALL)",
    ),
}
_ORDER = "ORDER BY score DESC, doc_id, shard_id"


def _scored(stats="global", stem=False, *more: str) -> str:
    return sql.with_(*_index(stem), *_SCORES[stats], *more)


def _ranked(name: str, source: str, k: int, by: str = "query_id") -> str:
    return (
        f"{name} AS (SELECT query_id, shard_id, doc_id, score, "
        f"row_number() OVER (PARTITION BY {by} {_ORDER}) AS rank FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {by} {_ORDER}) <= {k})"
    )


def _page(table: str, size: int, offset: int = 0) -> tuple[str, ...]:
    """Drop missing documents, rank what is left, cut the page."""
    return (
        f"present AS (SELECT f.* FROM scores f SEMI JOIN {table} USING (shard_id, doc_id))",
        _ranked("best", "present", size + offset),
        f"page AS (SELECT * FROM best WHERE rank > {offset})",
    )


def _hits(ranked: str, table: str) -> str:
    return (
        "SELECT query_id, rank, shard_id, doc_id, round(score, 6) AS score, title, "
        "CASE WHEN length(content) > 500 THEN substr(content, 1, 500) || '...' ELSE content END AS content, "
        "source, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at, "
        "'{\"lang\":\"' || lang || '\"}' AS metadata "
        f"FROM {ranked} JOIN {table} USING (shard_id, doc_id)"
    )


ORACLES = {
    "sch01_candidates": sql.with_(*_index(False))
    + "SELECT DISTINCT query_id, shard_id, doc_id FROM query_terms JOIN postings USING (term)",
    "sch02_tfidf": _scored() + f"SELECT {_SHOWN} FROM scores",
    "sch02_tfidf_shard": _scored("shard") + f"SELECT {_SHOWN} FROM scores",
    "sch03_top_k": _scored("global", False, _ranked("best", "scores", SIZE)) + f"SELECT {_SHOWN} FROM best",
    "sch03_top_k_deep": _scored("global", False, _ranked("best", "scores", 5000)) + f"SELECT {_SHOWN} FROM best",
    "sch04_assemble_hits": _scored("global", False, sql.MARKS, sql.KEPT, _ranked("best", "scores", SIZE))
    + _hits("best", "kept"),
    "sch05_snippet": sql.with_(sql.DOCS)
    + "SELECT doc_id, CASE WHEN length(content) > 500 THEN substr(content, 1, 500) || '...' "
    "ELSE content END AS content FROM docs",
    "sch06_paginate": _scored("global", False, *_page("docs", SIZE, 20)) + f"SELECT {_SHOWN} FROM page",
    "sch07_total_hits": _scored()
    + "SELECT query_id, count(*) AS total, least(count(*), 60) AS capped FROM scores GROUP BY ALL",
    "sch08_search_shard": _scored("shard", False, sql.MARKS, sql.KEPT, *_page("kept", SIZE)) + _hits("page", "kept"),
    "sch08_search_shard_page7": _scored("shard", False, sql.MARKS, sql.KEPT, *_page("kept", SIZE, 6 * SIZE))
    + _hits("page", "kept"),
    "sch09_search_most_missing": _scored(
        "global", False, "src3 AS (SELECT * FROM docs WHERE source = 'src3')", *_page("src3", SIZE)
    )
    + _hits("page", "src3"),
    "sch11_stop_words_only": _scored("global", False, *_page("docs", SIZE)) + _hits("page", "docs"),
    "sch12_search_long_query": sql.with_(
        sql.DOCS,
        sql.words("docs"),
        sql.QUERIES.replace("queries AS", "each_query AS", 1),
        "queries AS (SELECT 0::BIGINT AS query_id, string_agg(query, ' ' ORDER BY query) AS query FROM each_query)",
        _QUERY_WORDS,
        *sql.index("docs"),
        "query_terms AS (SELECT query_id, term, count(*) AS query_tf FROM asked GROUP BY ALL)",
        *_SCORES["global"],
        *_page("docs", SIZE),
    )
    + _hits("page", "docs"),
    "sch09_search_global": _scored("global", False, sql.MARKS, sql.KEPT, *_page("kept", SIZE, 5))
    + _hits("page", "kept"),
    "sch10_iso_timestamp": "SELECT event_id, CASE WHEN ts = date_trunc('second', ts) "
    "THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts FROM events",
    "sch12_search_batch": _scored("global", False, *_page("docs", SIZE)) + _hits("page", "docs"),
    "sch12_search_batch_stemmed": _scored("global", True, *_page("docs", SIZE)) + _hits("page", "docs"),
}
