"""Text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiquarry.functions import text
from lexiquarry.functions.stem import stem_tokens
from lexiquarry.operators import search
from lexiquarry.plans import sql, views


def _joined(tokens):
    return F.array_join(tokens, " ")


def txt01_tokenize(spark, sf):
    docs = views.texts(spark, sf)
    return docs.select("doc_id", _joined(text.tokenize("content")).alias("tokens"))


def txt02_alpha_only(spark, sf):
    docs = views.messages(spark, sf)
    return docs.select("doc_id", _joined(text.alpha_only(text.tokenize("content"))).alias("tokens"))


def txt03_remove_stopwords(spark, sf):
    docs = views.messages(spark, sf)
    words = text.remove_stopwords(text.alpha_only(text.tokenize("content")))
    return docs.select("doc_id", _joined(words).alias("tokens"), F.size(words).cast("bigint").alias("n_tokens"))


def txt04_stem_tokens(spark, sf):
    docs = views.texts(spark, sf)
    words = docs.select(F.explode(text.preprocess("content", stem=False)).alias("term")).distinct()
    return words.select("term", stem_tokens(F.array("term"))[0].alias("stem"))


def txt05_preprocess(spark, sf):
    docs = views.pages(spark, sf)
    return docs.select("doc_id", _joined(text.preprocess(text.full_text(), stem=False)).alias("tokens"))


def txt05_preprocess_stemmed(spark, sf):
    docs = views.texts(spark, sf)
    tokens = docs.select("doc_id", F.explode(text.preprocess("content")).alias("stem"))
    return tokens.groupBy("doc_id", "stem").agg(F.count("*").alias("tf"))


def txt06_typeahead_tokens(spark, sf):
    docs = views.texts(spark, sf)
    return docs.select("doc_id", _joined(text.typeahead_tokens("content")).alias("tokens"))


def txt07_full_text(spark, sf):
    return views.pages(spark, sf).select("doc_id", text.full_text().alias("full_text"))


def txt08_query_terms(spark, sf):
    return search.query_terms(views.queries(spark, sf), stem=False)


def txt09_normalize_term(spark, sf):
    rows = views.messages(spark, sf)
    padded = F.concat(F.lit(" \t"), "content", F.lit("\u00a0\n"))
    return rows.select("doc_id", text.normalize_term(padded).alias("term"))


QUERIES = {
    f.__name__: f
    for f in (
        txt01_tokenize,
        txt02_alpha_only,
        txt03_remove_stopwords,
        txt04_stem_tokens,
        txt05_preprocess,
        txt05_preprocess_stemmed,
        txt06_typeahead_tokens,
        txt07_full_text,
        txt08_query_terms,
        txt09_normalize_term,
    )
}

_LETTERS = "lambda t: regexp_full_match(t, '\\p{L}+')"
_MESSAGE_TOKENS = f"toks AS (SELECT doc_id, {sql.tokens('content')} AS t FROM messages)"
_PAGE_TEXT = "title || ' ' || content"

ORACLES = {
    "txt01_tokenize": sql.with_(sql.DOCS)
    + f"SELECT doc_id, array_to_string({sql.tokens('content')}, ' ') AS tokens FROM docs",
    "txt02_alpha_only": sql.with_(sql.MESSAGES, _MESSAGE_TOKENS)
    + f"SELECT doc_id, array_to_string(list_filter(t, {_LETTERS}), ' ') AS tokens FROM toks",
    "txt03_remove_stopwords": sql.with_(
        sql.MESSAGES,
        _MESSAGE_TOKENS,
        f"kept AS (SELECT doc_id, list_filter(t, lambda t: {sql.search_word('t')}) AS t FROM toks)",
    )
    + "SELECT doc_id, array_to_string(t, ' ') AS tokens, CAST(len(t) AS BIGINT) AS n_tokens FROM kept",
    "txt04_stem_tokens": sql.with_(
        sql.DOCS,
        sql.words("docs"),
        "vocabulary AS (SELECT DISTINCT term FROM words)",
        *sql.stems("vocabulary"),
    )
    + "SELECT term, stem FROM stems",
    "txt05_preprocess": sql.with_(sql.PAGE_DOCS)
    + f"SELECT doc_id, array_to_string(list_filter({sql.tokens(_PAGE_TEXT)}, "
    f"lambda t: {sql.search_word('t')}), ' ') AS tokens FROM page_docs",
    "txt05_preprocess_stemmed": sql.with_(
        sql.DOCS,
        sql.words("docs"),
        "vocabulary AS (SELECT DISTINCT term FROM words)",
        *sql.stems("vocabulary"),
    )
    + "SELECT doc_id, stem, count(*) AS tf FROM words JOIN stems USING (term) GROUP BY ALL",
    "txt06_typeahead_tokens": sql.with_(sql.DOCS)
    + f"SELECT doc_id, array_to_string(list_filter({sql.tokens('content')}, "
    f"lambda t: {sql.suggest_word('t')}), ' ') AS tokens FROM docs",
    "txt07_full_text": sql.with_(sql.PAGE_DOCS) + f"SELECT doc_id, {_PAGE_TEXT} AS full_text FROM page_docs",
    "txt08_query_terms": sql.with_(
        sql.QUERIES, f"toks AS (SELECT query_id, unnest({sql.tokens('query')}) AS term FROM queries)"
    )
    + f"SELECT query_id, term, count(*) AS query_tf FROM toks WHERE {sql.search_word()} GROUP BY ALL",
    "txt09_normalize_term": sql.with_(sql.MESSAGES)
    + "SELECT doc_id, trim(lower(concat(' ', chr(9), content, chr(160), chr(10))), "
    f"{sql.WHITE_SQL}) AS term FROM messages",
}
