"""The inverted index: three plain tables built from, and kept in step with, the documents.

`postings(shard_id, term, doc_id, tf, doc_len)`, `term_stats(shard_id, term, df)`
and `doc_stats(shard_id, doc_id, doc_len)`. The document length is repeated in
the postings, so that scoring needs no join on the document id.

Documents are unique on (shard_id, doc_id). A document's term counts are made
inside its row, so building the postings shuffles nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions.text import full_text, preprocess
from lexiquarry.session import lookup_side, remove_folder, settle
from lexiquarry.sources.tables import read_bucketed, write_bucketed

KEY = ["shard_id", "doc_id"]

POSTINGS = "term string, doc_id string, tf bigint, doc_len bigint, shard_id int, term_bucket int"
TERM_STATS = "term string, df bigint, shard_id int"
DOC_STATS = "doc_id string, doc_len bigint, shard_id int"
DOC_TERMS = "shard_id int, doc_id string, doc_len bigint, terms array<struct<term:string,tf:bigint>>"

# Files the counts by document are stored in, by a hash of the key: so many at least,
# and more where a file, which is one task when scores are summed, would hold too many documents.
DOC_FILES = 32
DOCS_PER_FILE = 8192

# From so many changed documents on, what is left of the postings is read by document.
MANY_KEYS = 50_000

# Directories the postings of a shard are split into by a hash of the term.
# Raise it with the corpus, to about a gigabyte of postings each.
TERM_BUCKETS = 16


@dataclass(frozen=True)
class Index:
    """The three tables; `buckets` is set when the postings are stored by term bucket.

    `doc_terms(shard_id, doc_id, doc_len, terms)` has the postings by document,
    stored in files by a hash of the key, so that the scores of many queries
    are summed where they lie.
    """

    postings: DataFrame
    term_stats: DataFrame
    doc_stats: DataFrame
    buckets: int | None = None
    doc_terms: DataFrame | None = None


def term_bucket(buckets: int, term: str | Column = "term") -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def analyze(docs: DataFrame, stem: bool = True) -> DataFrame:
    """One row per document: its search tokens in sorted order, repeats kept."""
    tokens = preprocess(full_text(), stem=stem)
    return docs.select(*KEY, F.sort_array(tokens).alias("tokens"))


def count_terms(analyzed: DataFrame) -> DataFrame:
    """One row per document: `doc_len` and `terms`, an array of (term, tf).

    The tokens are sorted, so a term is a run; its count is the distance between
    the start of its run and the start of the next.
    """
    starts = F.expr(
        "filter(sequence(0, size(tokens)), i -> i < size(tokens) and (i = 0 or tokens[i] != tokens[i - 1]))"
    )
    terms = F.expr(
        "transform(_starts, (p, i) -> struct(tokens[p] as term,"
        " cast(coalesce(get(_starts, i + 1), size(tokens)) - p as bigint) as tf))"
    )
    return analyzed.withColumn("_starts", starts).select(
        *KEY, F.size("tokens").cast("bigint").alias("doc_len"), terms.alias("terms")
    )


def postings(doc_terms: DataFrame) -> DataFrame:
    """One row per term of a document.

    The outer form of explode, because for the inner one the optimizer adds a
    filter on the size of the array, pushes it to the scan and so evaluates the
    whole text analysis a second time.
    """
    rows = doc_terms.select("shard_id", "doc_id", "doc_len", F.explode_outer("terms").alias("t"))
    return rows.where("t is not null").select("shard_id", "t.term", "doc_id", "t.tf", "doc_len")


def term_stats(entries: DataFrame) -> DataFrame:
    """In how many documents of the shard each term occurs."""
    return entries.groupBy("shard_id", "term").agg(F.count("*").alias("df"))


def doc_stats(doc_terms: DataFrame) -> DataFrame:
    """Token count per document; documents without tokens are there with zero."""
    return doc_terms.select("shard_id", "doc_id", "doc_len")


def corpus_size(stats: DataFrame) -> DataFrame:
    return stats.groupBy("shard_id").agg(F.count("*").alias("n_docs"))


def _index_of(doc_terms: DataFrame) -> Index:
    entries = postings(doc_terms)
    return Index(entries, term_stats(entries), doc_stats(doc_terms), doc_terms=doc_terms)


def build_index(docs: DataFrame, stem: bool = True, once: bool = False) -> Index:
    """The index as a plan over the documents. Use `write_index` to store it.

    Each of its tables analyzes the texts when it is read; with `once` they are
    analyzed when this is called, for callers that read more than one table.
    """
    doc_terms = count_terms(analyze(docs, stem))
    return _index_of(settle(doc_terms) if once else doc_terms)


def store_index(
    docs: DataFrame, path: str, stem: bool = True, buckets: int = TERM_BUCKETS
) -> Index:
    """Build the index of all documents into a new folder and return the stored tables.

    Every text is analyzed once: the per-document counts are written first, and
    the postings and statistics are derived from that table.
    """
    spark = docs.sparkSession
    files = _doc_files(docs)
    write_bucketed(count_terms(analyze(docs, stem)), f"{path}/doc_terms", KEY, files)
    doc_terms = spark.read.schema(DOC_TERMS).parquet(f"{path}/doc_terms")
    return _write_tables(_index_of(doc_terms), path, buckets, files)


def _doc_files(docs: DataFrame) -> int:
    """In how many files the counts of documents are stored; reads no texts."""
    return max(DOC_FILES, -(-docs.count() // DOCS_PER_FILE))


def write_index(index: Index, path: str, buckets: int = TERM_BUCKETS) -> Index:
    """Write the tables to a new folder and return them as stored."""
    files = _doc_files(index.doc_stats)
    write_bucketed(_by_document(index), f"{path}/doc_terms", KEY, files)
    return _write_tables(index, path, buckets, files)


def _by_document(index: Index) -> DataFrame:
    if index.doc_terms is not None:
        return index.doc_terms
    lists = index.postings.groupBy(*KEY).agg(F.collect_list(F.struct("term", "tf")).alias("terms"))
    return index.doc_stats.join(lists, KEY, "left").select(
        *KEY, "doc_len", F.coalesce("terms", F.array().cast("array<struct<term:string,tf:bigint>>")).alias("terms")
    )


def _write_tables(index: Index, path: str, buckets: int, files: int) -> Index:
    """Store all but the counts by document.

    Postings are laid out by shard and term bucket and sorted by term, so a
    query opens few files and skips within them by the page statistics. The
    rebalance hint splits a bucket that a hot term makes too large.
    """
    spark = index.postings.sparkSession
    laid_out = (
        _plain(index.postings)
        .withColumn("term_bucket", term_bucket(buckets))
        .hint("rebalance", F.col("shard_id"), F.col("term_bucket"))
        .sortWithinPartitions("shard_id", "term_bucket", "term", "doc_id")
    )
    laid_out.write.partitionBy("shard_id", "term_bucket").parquet(f"{path}/postings")
    stored = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    term_stats(stored).write.partitionBy("shard_id").parquet(f"{path}/term_stats")
    index.doc_stats.write.partitionBy("shard_id").parquet(f"{path}/doc_stats")
    layout = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(files).alias("doc_files"))
    layout.write.parquet(f"{path}/layout")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    def stored(schema: str, name: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    layout = stored("buckets int, doc_files int", "layout").first()
    return Index(
        stored(POSTINGS, "postings"),
        stored(TERM_STATS, "term_stats").select("shard_id", "term", "df"),
        stored(DOC_STATS, "doc_stats").select("shard_id", "doc_id", "doc_len"),
        layout["buckets"],
        read_bucketed(spark, f"{path}/doc_terms", DOC_TERMS, KEY, layout["doc_files"]),
    )


def publish_index(docs: DataFrame, root: str, stem: bool = True, buckets: int = TERM_BUCKETS) -> Index:
    """Rebuild the index next to the one in use and make it the current one.

    The new version is recorded only when all its tables are written, and no
    folder is ever written twice, so readers always see a whole index.
    """
    spark = docs.sparkSession
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    index = store_index(docs, folder, stem, buckets)
    recorded = spark.range(1).select(F.lit(folder).alias("folder"), F.current_timestamp().alias("at"))
    recorded.write.mode("append").parquet(f"{root}/versions")
    return index


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the tables of all but the `keep` versions published last; for when no reader is left on them."""
    versions = spark.read.parquet(f"{root}/versions").orderBy(F.desc("at")).select("folder").collect()
    old = [v["folder"] for v in versions[max(keep, 1) :]]
    for folder in old:
        remove_folder(spark, folder)
    return len(old)


def current_index(spark: SparkSession, root: str) -> Index:
    """The index published last."""
    versions = spark.read.parquet(f"{root}/versions")
    return read_index(spark, versions.orderBy(F.desc("at")).first()["folder"])


def _plain(entries: DataFrame) -> DataFrame:
    return entries.select("shard_id", "term", "doc_id", "tf", "doc_len")


def many(keys: DataFrame) -> bool:
    """Whether a stored table of keys is better met with rows by document than with single postings."""
    return keys.count() >= MANY_KEYS


def _parted(index: Index, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The postings of other documents than these, and those of these.

    Few keys are broadcast to the postings. Many would shuffle and sort every
    posting to its document; the counts by document lie together already.
    """
    if index.doc_terms is not None and many(keys):
        rows, spelled = index.doc_terms, postings
    else:
        rows, spelled = index.postings, _plain
    return spelled(rows.join(keys, KEY, "left_anti")), spelled(rows.join(keys, KEY, "left_semi"))


def _moved(stats: DataFrame, gone: DataFrame, come: DataFrame | None) -> DataFrame:
    """Document frequencies after some postings left and others arrived; zero drops the term.

    Costs a pass over the changed postings and the vocabulary, not over the index.
    """
    changes = stats.unionByName(term_stats(gone).withColumn("df", -F.col("df")))
    if come is not None:
        changes = changes.unionByName(term_stats(come))
    return changes.groupBy("shard_id", "term").agg(F.sum("df").alias("df")).where("df > 0")


def index_delete(index: Index, ids: DataFrame) -> Index:
    """Take documents out of the index; unknown ids change nothing."""
    keys = lookup_side(ids.select(*KEY).distinct())
    left, gone = _parted(index, keys)
    return Index(
        left,
        _moved(index.term_stats, gone, None),
        index.doc_stats.join(keys, KEY, "left_anti"),
        doc_terms=None if index.doc_terms is None else index.doc_terms.join(keys, KEY, "left_anti"),
    )


def index_upsert(index: Index, changed: DataFrame, stem: bool = True) -> Index:
    """Replace the entries of changed documents and add those of new ones."""
    doc_terms = settle(count_terms(analyze(changed, stem)))
    added = _index_of(doc_terms)
    keys = doc_terms.select(*KEY)
    left, gone = _parted(index, keys)
    return Index(
        left.unionByName(added.postings),
        _moved(index.term_stats, gone, added.postings),
        index.doc_stats.join(keys, KEY, "left_anti").unionByName(added.doc_stats),
        doc_terms=None
        if index.doc_terms is None
        else index.doc_terms.join(keys, KEY, "left_anti").unionByName(doc_terms),
    )


def reindex(docs: DataFrame, index: Index, stem: bool = True) -> Index:
    """Index every document again; entries of documents no longer in the table stay."""
    return index_upsert(index, docs, stem)


def index_stats(docs: DataFrame, index: Index, sizes: DataFrame | None = None) -> DataFrame:
    """Documents in the table, documents in the index and distinct terms, per shard.

    With `sizes` (shard_id, index_size_bytes), as `stored_index.shard_bytes` gives them, the stored bytes, too.
    """
    in_db = docs.groupBy("shard_id").agg(F.count("*").alias("documents_in_db"))
    in_index = index.doc_stats.groupBy("shard_id").agg(F.count("*").alias("documents_in_index"))
    terms = index.term_stats.groupBy("shard_id").agg(F.count("*").alias("unique_terms"))
    joined = in_db.join(in_index, "shard_id", "full").join(terms, "shard_id", "full")
    counts = ["documents_in_db", "documents_in_index", "unique_terms"]
    if sizes is not None:
        joined = joined.join(sizes.where("shard_id is not null"), "shard_id", "full")
        counts.append("index_size_bytes")
    return joined.select("shard_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts])


def index_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Stored size of the index; reads file lengths only, not the files."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load([f"{path}/{table}" for table in ("postings", "term_stats", "doc_stats")])
    )
    return files.agg(F.sum("length").alias("index_size_bytes"))
