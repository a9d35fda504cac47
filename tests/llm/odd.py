"""A small table with everything that tends to break operators, and helpers of these tests."""

from pyspark.sql import functions as F

SENTENCE = "The white whale swam far out into the cold northern sea and nobody saw it come back again."
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ROWS = [
    (1, SENTENCE, "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, "   \n\t  ", "en", None, 7),
    (5, "x" * 60_000, "en", "a", 60_000),
    (6, (SENTENCE + "\n") * 800, "en", "a", 1),
    (7, SENTENCE, "en", "a", 1),
    (7, SENTENCE, "en", "a", 1),
    (None, "Ein weißer Wal schwamm weit hinaus in das kalte Meer im Norden.", "de", "b", 3),
    (None, None, None, None, None),
    (9, "12 34 !! ?? 56", "de", "b", 3),
    (10, "日本語のテキスト と emoji 😀😀 é é", None, "b", 3),
    (11, "\n\n" + SENTENCE + "\n\n\n" + SENTENCE.upper(), "en", "b", 3),
]

# Names that operators give their own columns.
CLASHES = [
    "n_words", "n_hit", "items", "spans", "lang_pred", "score", "cosine", "n_tokens", "n_bytes", "over_limit",
    "predicted", "fingerprint", "simhash", "component_id", "n_lines", "n_removed", "n_values", "length", "start",
    "key", "line", "t", "k0", "f0", "trie", "part", "size", "rank", "label", "mark", "html", "count",
]


def odd(spark):
    """The rows, with further columns of clashing names."""
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def empty(spark):
    return odd(spark).where("false")


def docs(spark, *texts, first=1):
    return spark.createDataFrame([(first + k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
