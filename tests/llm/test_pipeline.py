import hashlib

import pytest

from lexiquarry.llm import simhash
from lexiquarry.llm.rows import settle
from llm.odd import ROWS, SCHEMA, SENTENCE
from llm.test_decontamination import brute
from llm.test_near_duplicates import groups, slow_lines, slow_simhash
from llm.test_tokens_packing import check_pieces

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture
def folder(spark, tmp_path):
    """Tables of a small corpus with copies, shared lines, benchmark text and odd rows."""
    words = "bright cold deep early far green high idle just kind long mild near open pale quiet red soft tall".split()

    def prose(k):
        mark = hashlib.md5(str(k).encode()).hexdigest()
        return " ".join(words[int(c, 16)] + mark[j % 32] for j, c in enumerate(mark * 2))

    rows = [(100 + k, f"{prose(k)}.\n{prose(k % 5)}\n{prose(1000 + k)}", "en", "s", 1) for k in range(30)]
    rows += [(200 + k, f"{prose(50)} {'again ' * (k % 2)}", "en", "s", 1) for k in range(4)]
    # Repeated keys with texts of their own, and copies without a key.
    rows += [(400, prose(400), "en", "s", 1), (400, prose(401), "en", "s", 1), (400, prose(100), "en", "s", 1)]
    rows += [(None, prose(400), "en", "s", 1), (None, prose(402), "en", "s", 1), (None, prose(402), "en", "s", 1)]
    rows += [(300, SENTENCE + " tail words", "en", "s", 1), (301, SENTENCE + " " + prose(77) * 12, "en", "s", 1)]
    folder = str(tmp_path)
    spark.createDataFrame([*rows, *ROWS], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    bench = spark.createDataFrame([(1, SENTENCE), (2, "no such words here")], "item_id bigint, text string")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, folder), name)
        assert docs.columns == columns
        kept[name] = [(r.doc_id, r.text, r.n_chars) for r in docs.collect()]
    texts = {k: t for k, t, _ in kept["language_id"]}
    assert not any(k in texts for k in (2, 3, 4, 9)) and {100, 200, 300, 1, 6, 7} <= set(texts)

    lines = {k: t for k, t, _ in kept["line_dedup"]}
    single = {k for k in texts if k is not None and sum(k == other for other, _, _ in kept["language_id"]) == 1}
    named = {k: t for k, t in texts.items() if k in single}
    assert {k: t for k, t in lines.items() if k in single} == slow_lines(named, short=True)
    assert all(n == len(t) for _, t, n in kept["line_dedup"])

    # Of each group one row, whatever its key: rows are told apart by their place in the list.
    before = [(k, t) for k, t, _ in kept["line_dedup"]]
    fp = {n: slow_simhash(t) for n, (_, t) in enumerate(before)}
    linked = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= simhash.MAX_BITS]
    grouped = {}
    for n, root in groups(fp, linked).items():
        grouped.setdefault(root, []).append(before[n])
    left = [(k, t) for k, t, _ in kept["simhash_near_dedup"]]
    assert len(left) == len(grouped)
    for members in grouped.values():
        first = min((k is None, k or 0) for k, _ in members)
        assert sum((k is None, k or 0) == first and (k, t) in members for k, t in left) >= 1

    before = [(k, t) for k, t, _ in kept["simhash_near_dedup"]]
    found = brute([t for _, t in before], [("1", SENTENCE), ("2", "no such words here")])
    clean = [k for (k, _), (n, hit, _) in zip(before, found, strict=True) if not (hit and 20 * hit >= n)]
    assert sorted(map(str, clean)) == sorted(str(k) for k, _, _ in kept["decontamination"])

    pieces = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    left = [(k, t) for k, t, _ in kept["decontamination"]]
    check_pieces(pieces, {k: t for k, t in left if [key for key, _ in left].count(k) == 1}, 4096)


def test_run_is_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES:
        docs = settle(stage(spark, docs, folder), name)
    got = pipeline.run(spark, folder)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()))
    assert pipeline.ORACLE_SQL is None and len(pipeline.STAGES) == 5


def test_nothing_in_nothing_out(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert pipeline.run(spark, folder).count() == 0
