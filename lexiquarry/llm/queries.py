"""The registered queries of these operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.llm import (
    curve_search,
    decontamination,
    fingerprints,
    html_extraction,
    language,
    line_dedup,
    manifest,
    packing,
    periodic_runs,
    pii,
    quality,
    simhash,
    sql,
    token_counts,
)
from lexiquarry.llm.rows import lookup_side, spread_rows, table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_rows(table(spark, sf_dir, "documents"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page by a labeller trained on layouts of the table's sentences."""
    pages = spread_rows(table(spark, sf_dir, "pages"))
    return html_extraction.extract(pages, html_extraction.fit(pages), keep=["page_id", "url"])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that an earlier place has alike."""
    return line_dedup.dedup_lines(_docs(spark, sf_dir), keep=["doc_id", "text"], short=True)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document is made of benchmark phrases, by an FM-index of each shard."""
    found = decontamination.decontaminate(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontamination.digest(found)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each text by hyperdimensional profiles of the rows that may teach."""
    docs = _docs(spark, sf_dir)
    names, prototypes = language.fit(docs.where(language.learns()))
    held = docs.withColumn("held_out", ~language.learns())
    found = language.identify(held, names, prototypes, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "cosine")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each text under piece_bpe_32k.model."""
    import public_tokenizers

    return token_counts.count_tokens(
        _docs(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"]
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each text by a model of the labelled rows that may teach."""
    docs = _docs(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # At most SAMPLE_ROWS keys, so the texts stay where they are.
    labels = labels.where(quality.learns())
    many = quality.totals(labels)
    sample = F.broadcast(quality.sampled(labels, many=many))
    training = docs.select("doc_id", "text").join(sample, "doc_id")
    held = docs.withColumn("held_out", ~quality.learns())
    return quality.score(held, quality.fit(training, whole=many), keep=["doc_id", "held_out"])


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of each text and its edited form, and what they share with it and the next document."""
    return fingerprints.compare_next(_docs(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens."""
    import public_tokenizers

    pieces = packing.token_pieces(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    found = simhash.near_duplicates(_docs(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


# The registered query needs a key that stays the same; a real one comes from the caller.
PII_KEY = "registered query"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with personal values replaced by pseudonyms, and how many there were."""
    docs = _docs(spark, sf_dir)
    return pii.pseudonymise(docs, PII_KEY, keep=["doc_id", "text"])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of each text, some of which are given a periodic tail by the key's checksum."""
    docs = _docs(spark, sf_dir).select("doc_id", periodic_runs.repeating().alias("text"))
    return periodic_runs.digest(periodic_runs.find_runs(docs, keep=["doc_id"]), ["doc_id"])


def op12_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors of each whose id is divisible by twenty."""
    return curve_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of the documents by source, and each document's proof, of which some texts were tampered with."""
    leaf = manifest.leaf_hash(LEAF)
    lowered = manifest.leaf_hash(LEAF, text=F.translate("text", CAPITALS, CAPITALS.lower()))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    told = F.when(tampered, lowered).otherwise(F.col("leaf")).alias("told")
    docs = _docs(spark, sf_dir).withColumn("leaf", leaf).select("doc_id", "source", "leaf", told)
    made = manifest.build(docs, key="doc_id", group="source", told="told")
    found = manifest.climb(made).join(lookup_side(made.trees.select("tree", "subroot")), "tree")
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(made.root).alias("root"),
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.lit(made.root)).alias("verified"),
    )


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_fingerprints": op7_fingerprints,
    "op8_packing": op8_packing,
    "op9_simhash": op9_simhash,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_curve_search": op12_curve_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op12_curve_search": sql.OP12,
    "op13_merkle_manifest": sql.OP13,
}
