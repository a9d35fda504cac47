"""Index build and maintenance over the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiquarry.operators import index as ops
from lexiquarry.operators import stored_index
from lexiquarry.plans import sql, views
from lexiquarry.session import shared_folder


def _plain(entries):
    return entries.select("shard_id", "term", "doc_id", "tf")


def _flat(index):
    """The three tables of an index as one, so that a query checks all of them."""
    entries = _plain(index.postings)
    stats = index.term_stats.select(
        "shard_id", "term", F.lit("(df)").alias("doc_id"), F.col("df").alias("tf")
    )
    lengths = index.doc_stats.select(
        "shard_id", F.lit("(len)").alias("term"), "doc_id", F.col("doc_len").alias("tf")
    )
    return entries.unionByName(stats).unionByName(lengths)


def src06_index_round_trip(spark, sf):
    path = shared_folder(spark, "index")
    ops.store_index(views.texts(spark, sf), path, stem=False)
    return _flat(ops.read_index(spark, path))


def idx01_postings(spark, sf):
    doc_terms = ops.count_terms(ops.analyze(views.texts(spark, sf), stem=False))
    return ops.postings(doc_terms)


def idx01_postings_stemmed(spark, sf):
    return _plain(ops.build_index(views.pages(spark, sf)).postings)


def idx02_term_stats(spark, sf):
    return ops.build_index(views.texts(spark, sf), stem=False).term_stats


def idx03_doc_stats(spark, sf):
    return ops.build_index(views.texts(spark, sf), stem=False).doc_stats


def idx04_corpus_size(spark, sf):
    return ops.corpus_size(ops.build_index(views.texts(spark, sf), stem=False).doc_stats)


def idx05_build_index(spark, sf):
    both = views.texts(spark, sf).unionByName(views.pages(spark, sf))
    return _flat(ops.build_index(both, stem=False, once=True))


def _changed(spark, sf):
    return views.reviewed(spark, sf).unionByName(views.pages(spark, sf))


def idx06_index_upsert(spark, sf):
    index = views.stored_index(spark, sf, stem=False)
    return _flat(ops.index_upsert(index, _changed(spark, sf), stem=False))


def idx07_index_delete(spark, sf):
    return _flat(ops.index_delete(views.stored_index(spark, sf, stem=False), views.toxic(spark, sf)))


def idx08_reindex(spark, sf):
    """The table lost the toxic documents and retitled others; entries of the lost ones stay."""
    index = views.stored_index(spark, sf, stem=False)
    gone = views.toxic(spark, sf)
    retitled = views.reviewed(spark, sf).join(gone, ["shard_id", "doc_id"], "left_anti")
    return _flat(ops.reindex(retitled, index, stem=False))


def idx09_index_stats(spark, sf):
    index = views.stored_index(spark, sf, stem=False)
    return ops.index_stats(views.kept(spark, sf), index)


def _stored(spark, sf):
    """The corpus index on disk, in a folder of its own."""
    root = shared_folder(spark, "stored")
    stored_index.create_index(views.texts(spark, sf), root, stem=False)
    return root


def idx06_upsert_stored(spark, sf):
    """Retitled documents are merged in, pages lie beside as a segment."""
    root = _stored(spark, sf)
    stored_index.upsert_index(spark, root, views.reviewed(spark, sf))
    stored_index.merge_index(spark, root)
    stored_index.upsert_index(spark, root, views.pages(spark, sf))
    return _flat(stored_index.open_index(spark, root))


def idx07_delete_stored(spark, sf):
    root = _stored(spark, sf)
    stored_index.delete_from_index(spark, root, views.toxic(spark, sf))
    return _flat(stored_index.open_index(spark, root))


def idx08_reindex_stored(spark, sf):
    root = _stored(spark, sf)
    gone = views.toxic(spark, sf)
    stored_index.reindex_stored(spark, root, views.reviewed(spark, sf).join(gone, ["shard_id", "doc_id"], "left_anti"))
    return _flat(stored_index.open_index(spark, root))


QUERIES = {
    f.__name__: f
    for f in (
        src06_index_round_trip,
        idx01_postings,
        idx01_postings_stemmed,
        idx02_term_stats,
        idx03_doc_stats,
        idx04_corpus_size,
        idx05_build_index,
        idx06_index_upsert,
        idx07_index_delete,
        idx08_reindex,
        idx09_index_stats,
        idx06_upsert_stored,
        idx07_delete_stored,
        idx08_reindex_stored,
    )
}

_BASE = (sql.DOCS, sql.words("docs"), *sql.index("docs"))


def _all(source: str, *ctes: str) -> str:
    """The flat index of a document CTE, rebuilt from scratch."""
    return (
        sql.with_(*ctes, sql.words(source), *sql.index(source))
        + "SELECT shard_id, term, doc_id, tf FROM postings UNION ALL "
        "SELECT shard_id, term, '(df)', df FROM term_stats UNION ALL "
        "SELECT shard_id, '(len)', doc_id, doc_len FROM doc_stats"
    )


_COLUMNS = "shard_id, doc_id, title, content"
_AFTER_UPSERT = (
    f"after AS (SELECT {_COLUMNS} FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM marks) UNION ALL "
    f"SELECT {_COLUMNS} FROM reviewed UNION ALL SELECT {_COLUMNS} FROM page_docs)"
)
_AFTER_REINDEX = (
    f"after AS (SELECT d.shard_id, d.doc_id, CASE toxic WHEN 0 THEN 'quality ' || quality ELSE '' END AS title, "
    "d.content FROM docs d LEFT JOIN marks USING (doc_id))"
)

ORACLES = {
    "src06_index_round_trip": _all("docs", sql.DOCS),
    "idx01_postings": sql.with_(*_BASE)
    + "SELECT shard_id, term, doc_id, tf, doc_len FROM postings JOIN doc_stats USING (shard_id, doc_id)",
    "idx01_postings_stemmed": sql.with_(
        sql.PAGE_DOCS,
        sql.words("page_docs"),
        "vocabulary AS (SELECT DISTINCT term FROM words)",
        *sql.stems("vocabulary"),
    )
    + "SELECT shard_id, stem AS term, doc_id, count(*) AS tf FROM words JOIN stems USING (term) GROUP BY ALL",
    "idx02_term_stats": sql.with_(*_BASE) + "SELECT shard_id, term, df FROM term_stats",
    "idx03_doc_stats": sql.with_(*_BASE) + "SELECT shard_id, doc_id, doc_len FROM doc_stats",
    "idx04_corpus_size": sql.with_(sql.DOCS) + "SELECT shard_id, count(*) AS n_docs FROM docs GROUP BY ALL",
    "idx05_build_index": _all(
        "both_docs",
        sql.DOCS,
        sql.PAGE_DOCS,
        f"both_docs AS (SELECT {_COLUMNS} FROM docs UNION ALL SELECT {_COLUMNS} FROM page_docs)",
    ),
    "idx06_index_upsert": _all("after", sql.DOCS, sql.PAGE_DOCS, sql.MARKS, sql.REVIEWED, _AFTER_UPSERT),
    "idx07_index_delete": _all("kept", sql.DOCS, sql.MARKS, sql.KEPT),
    "idx08_reindex": _all("after", sql.DOCS, sql.MARKS, _AFTER_REINDEX),
    "idx09_index_stats": sql.with_(
        *_BASE,
        sql.MARKS,
        sql.KEPT,
        "n_kept AS (SELECT shard_id, count(*) AS documents_in_db FROM kept GROUP BY ALL)",
        "n_docs AS (SELECT shard_id, count(*) AS documents_in_index FROM docs GROUP BY ALL)",
        "n_terms AS (SELECT shard_id, count(*) AS unique_terms FROM term_stats GROUP BY ALL)",
    )
    + "SELECT * FROM n_kept JOIN n_docs USING (shard_id) JOIN n_terms USING (shard_id)",
}
for _name, _same in (
    ("idx06_upsert_stored", "idx06_index_upsert"),
    ("idx07_delete_stored", "idx07_index_delete"),
    ("idx08_reindex_stored", "idx08_reindex"),
):
    ORACLES[_name] = ORACLES[_same]
