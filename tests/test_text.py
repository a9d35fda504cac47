import random

import pytest
from pyspark.sql import functions as F

from lexiquarry.functions import text


def words(spark, texts, function):
    frame = spark.createDataFrame([(t,) for t in texts], "content string")
    return [r[0] for r in frame.select(function(F.col("content"))).collect()]


@pytest.mark.parametrize(
    ("content", "expected"),
    [
        ("Machine learning, e.g. deep-learning: it's 3,000 docs.", ["machine", "learning", "it", "docs"]),
        ("and/or U.S. (see foo.com)!", ["see"]),
        ("I cannot. We don't; dogs' x.y", ["i", "can", "not", "we", "do", "dogs"]),
        ("naïve Straße a_b b2", ["naïve", "straße"]),
        ("", []),
        (None, []),
    ],
)
def test_tokens_before_stop_words(spark, content, expected):
    assert words(spark, [content], lambda c: text.alpha_only(text.tokenize(c))) == [expected]


def test_stop_words_and_stems(spark):
    content = "The runners were running and running quickly"
    assert words(spark, [content], lambda c: text.preprocess(c, stem=False)) == [
        ["runners", "running", "running", "quickly"]
    ]
    assert words(spark, [content], text.preprocess) == [["runner", "run", "run", "quickli"]]


def test_typeahead_tokens_need_two_letters(spark):
    assert words(spark, ["x ray B12 zz the"], text.typeahead_tokens) == [["ray", "zz"]]


def test_one_pattern_equals_the_rule_chain(spark):
    random.seed(7)
    parts = ["a", "not", "cannot", "don't", "it's", ",", ":", ".", "..", "--", "-", "'", " ", "\n", "5"]
    parts += ["(", ")", "é", "’", "n't", "'s", "ß", "#", "%%%", "***"]
    texts = ["".join(random.choices(parts, k=random.randint(1, 14))) for _ in range(20000)]
    frame = spark.createDataFrame([(t,) for t in texts], "content string")
    chain = text.remove_stopwords(text.alpha_only(text.tokenize("content")))
    assert frame.where(chain != text.preprocess("content", stem=False)).count() == 0


def test_normalize_strips_unicode_space(spark):
    assert words(spark, ["  Mach\tine 　\n", "  "], text.normalize_term) == ["mach\tine", ""]


def test_word_count_splits_like_split(spark):
    texts = ["a b\tc", "  x y ", "", "one"]
    assert words(spark, texts, text.word_count) == [len(t.split()) for t in texts]


def test_snippet_boundary(spark):
    short, long = "x" * 500, "x" * 501
    assert words(spark, [short, long], text.snippet) == [short, short + "..."]


def test_iso_timestamp(spark):
    frame = spark.sql(
        "select explode(array(timestamp '2024-01-02 03:04:05', timestamp '2024-01-02 03:04:05.25', null)) ts"
    )
    got = [r[0] for r in frame.select(text.iso_timestamp("ts")).collect()]
    assert got == ["2024-01-02T03:04:05", "2024-01-02T03:04:05.250000", None]


def test_unicode_white_space_separates(spark):
    phrase = "machine\u00a0learning rocks\u2003deep\u3000sea"
    row = spark.createDataFrame([(phrase,)], "t string").select(text.tokenize("t"), text.preprocess("t", stem=False)).first()
    assert list(row[0]) == list(row[1]) == ["machine", "learning", "rocks", "deep", "sea"]
