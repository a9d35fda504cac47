"""The Merkle manifest and its proofs against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexiquarry.llm import manifest, queries
from tests.llm.odd import SCHEMA, empty, odd

CAPITALS = {c: c + 32 for c in range(65, 91)}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(levels, at):
    """Siblings of the node, from the lowest level up."""
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
        out.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return out


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][k : k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def plain(rows):
    """Rows (doc_id, text, lang, source, n_chars) -> rows of the query."""
    groups = {}
    for doc, text, lang, source, n in rows:
        own = leaf((doc, source, lang, n, text))
        told = own
        if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 5 == 0:
            told = leaf((doc, source, lang, n, text.translate(CAPITALS)))
        groups.setdefault(source, []).append((doc, own, told))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = levels_of([r[1] for r in groups[name]])
    top = levels_of([trees[name][-1][0] for name in names])
    out = []
    for which, name in enumerate(names):
        for at, (doc, own, told) in enumerate(groups[name]):
            siblings = climb(trees[name], at) + climb(top, which)
            folded = told
            for before, after in siblings:
                folded = digest(*before, folded, *after)
            proof = digest(*(h for before, after in siblings for h in (*before, *after)))
            root = top[-1][0]
            out.append((doc, own, trees[name][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def got(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    found = queries.op13_merkle_manifest(spark, str(folder))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def made(n, sources, seed=3):
    rng = random.Random(seed)
    for k in rng.sample(range(10 * n), n):
        text = "".join(rng.choice("aBc Dé日😀\n") for _ in range(rng.randint(0, 30)))
        yield (k, None if k % 17 == 0 else text, rng.choice(["en", None]), sources(k), rng.choice([None, len(text)]))


@pytest.mark.parametrize(
    "n, sources",
    [
        (1, lambda k: "a"),
        (16, lambda k: "a"),
        (17, lambda k: None),
        (700, lambda k: "hot" if k % 3 else f"s{k % 5}"),
        (300, lambda k: f"every {k}"),
        (400, lambda k: [None, "é", "z", "日", "Z", ""][k % 6]),
    ],
)
def test_query_equals_plain_python(spark, tmp_path, n, sources):
    rows = list(made(n, sources))
    expected = plain(rows)
    assert got(spark, rows, tmp_path) == expected
    if n > 100:
        assert 0 < sum(not r[-1] for r in expected) < n / 4


def test_many_climbers_meet_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "CROWD", 2)
    rows = list(made(600, lambda k: f"s{k % 40}" if k % 3 else "hot"))
    assert got(spark, rows, tmp_path) == plain(rows)


def test_null_and_repeated_keys_and_clashing_columns(spark, tmp_path):
    rows = [(None, "A", "en", "a", 1), (None, "A", "en", "a", 1), (None, "b", "en", None, 1)] + [(5, "A", None, "a", 1)] * 40
    assert got(spark, rows, tmp_path) == plain(rows)
    names = ["leaf", "told", "tree", "ord", "key", "name", "part", "at"]
    frame = odd(spark).withColumns({c: F.lit("own") for c in names})
    leaves = frame.withColumn("of", manifest.leaf_hash(queries.LEAF))
    found = manifest.build(leaves, "doc_id", "source", leaf="of")
    climbed = manifest.climb(found).collect()
    assert len(climbed) == frame.count() and all(r["folded_root"] == found.root for r in climbed)


def test_empty_table(spark, tmp_path):
    found = manifest.build(empty(spark).withColumn("leaf", F.lit("x")), "doc_id", "source")
    assert found.root is None and manifest.climb(found).collect() == []
    empty(spark).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_merkle_manifest(spark, str(tmp_path)).collect() == []


def test_a_changed_leaf_is_told_from_the_others(spark):
    frame = spark.range(900).select(F.col("id").alias("k"), F.lit("one").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    told = frame.withColumn("told", F.when(F.col("k") == 450, F.sha2(F.lit("other"), 256)).otherwise(F.col("leaf")))
    found = manifest.build(told, "k", "g", told="told")
    wrong = [r["key"] for r in manifest.climb(found).collect() if r["folded_root"] != found.root]
    assert wrong == [450]
    proof = manifest.climb(found).where("key = 0").first()["proof"]
    assert len(proof) == 64 * (15 + 15 + 3)  # 900, 57, 4, 1


def test_numbers_go_on_over_partitions(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("v"))
    got_rows = manifest.numbered(rows, ["g"], ["v"]).collect()
    for g in range(3):
        own = sorted((r["v"], r["ord"]) for r in got_rows if r["g"] == g)
        assert [o for _, o in own] == list(range(len(own)))
