import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm.odd import ROWS, docs, empty, odd
from lexiquarry.llm import line_dedup, simhash
from lexiquarry.llm.components import components


def slow_simhash(text, shingle=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    count = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run, 42)
        for bit in range(64):
            count[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * count[bit] > len(runs))


def groups(nodes, linked):
    """The smallest node each is connected to."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    texts = []
    while len(texts) < n:
        base = rng.choices(vocabulary, k=rng.choice([1, 3, 30, 150]))
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts[:n]


def test_fingerprints_bit_by_bit(spark):
    texts = near_texts(1, 40) + ["", None, "One", "One two", "A b\tC\x0bd  e", "é " * 700]
    got = simhash.simhashes(docs(spark, *texts)).orderBy("doc_id").collect()
    assert [r.simhash % (1 << 64) for r in got] == [slow_simhash(t) for t in texts]


@pytest.mark.parametrize("most", [4096, 6])
@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_components_against_all_pairs(spark, most, max_bits):
    texts = near_texts(max_bits + 7, 150)
    got = simhash.near_duplicates(docs(spark, *texts), max_bits=max_bits, most=most).collect()
    fp = {k + 1: slow_simhash(t) for k, t in enumerate(texts)}
    linked = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= max_bits]
    assert {r.doc_id: r.component_id for r in got} == groups(fp, linked)


@pytest.mark.parametrize("lot", [1 << 20, 50])
def test_trie_join_gives_every_near_pair(monkeypatch, lot):
    monkeypatch.setattr(simhash, "LOT", lot)
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    bits = np.concatenate([bits ^ np.uint64(1 << int(k)) for k in rng.integers(0, 50, 30)] + [bits, bits[:3]])
    group = rng.integers(0, 2, len(bits))
    order = np.lexsort((bits, group))
    bits, group = bits[order], group[order]
    found = set()
    simhash.trie_join(group, bits, 0, 3, lambda a, b: found.update(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())))
    places = range(len(bits))
    assert found == {
        (a, b) for a in places for b in places
        if a < b and group[a] == group[b] and (int(bits[a]) ^ int(bits[b])).bit_count() <= 3
    }


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 240)] + [(1, 2), (2, 1), (3, 3)]
    links += [tuple(rng.sample(range(300, 360), 2)) for _ in range(40)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.root for r in got.collect()} == groups(nodes, [p for p in links if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    assert len(got) == 13
    # Null, empty and blank texts are linked with fingerprint zero.
    assert {r.component_id for r in got if r.simhash == 0} == {2}
    assert [r.component_id for r in got if r.doc_id == 7] == [1, 1]
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = simhash.deduplicate(odd(spark))
    ids = [r.doc_id for r in kept.collect()]
    assert 7 not in ids and 1 in ids and 3 not in ids and 4 not in ids and ids.count(2) == 1
    assert ids.count(None) == 1  # the one without text is a copy of 2
    assert kept.columns == odd(spark).columns
    twice = docs(spark, "red sea", "blue sea").unionByName(docs(spark, "red sea"))
    assert sorted(r.doc_id for r in simhash.deduplicate(twice).collect()) == [1, 2]
    assert simhash.deduplicate(empty(spark)).count() == 0


def test_rows_of_one_key_are_judged_by_their_own_text(spark):
    a, b, c, d = (f"{w} swam far out into the cold northern sea {w} and nobody saw {w} again" for w in ("owl", "elk", "emu", "yak"))
    schema = "doc_id bigint, text string, n int"
    rows = [(5, a, 1), (7, a, 2), (7, b, 3), (9, c, 4), (9, d, 5), (None, a, 6), (None, "lone text of its own here", 7)]
    rows += [(None, "twice without any key at all", 8)] * 2 + [(11, "twice with a key and more", 9), (11, "twice with a key and more", 10)]
    got = [tuple(r) for r in simhash.deduplicate(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(r[2] for r in got if r[2] < 9) == [1, 3, 4, 5, 7, 8]
    assert len([r for r in got if r[2] >= 9]) == 1 and len(got) == 7
    again = simhash.deduplicate(spark.createDataFrame(list(reversed(rows)), schema).repartition(5))
    assert sorted(map(repr, got)) == sorted(repr(tuple(r)) for r in again.collect())


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(1500):
        a = "".join(rng.choice("ab é") for _ in range(rng.randint(0, 30)))
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 2)] = rng.choice(["", "x", "a", "bc"])
        b, most = "".join(b), rng.randint(0, 10)
        expected, got = slow_distance(a, b), line_dedup.distance(a, b, most)
        assert got == expected if expected <= most else got > most


def slow_lines(texts, max_bits=4, similarity=0.8, min_words=5, prints=line_dedup.PRINTS, short=False):
    """Texts without the lines that an earlier place has alike, by comparing all pairs."""
    import pyarrow as pa

    places = {}
    for key, text in sorted(texts.items()):
        for k, line in enumerate((text or "").split("\n")):
            norm = line_dedup.normal(line)
            if len(norm.split()) >= (1 if short else min_words):
                places.setdefault(norm, []).append((key, k))
    lines = list(places)
    fp = list(zip(*(x.tolist() for x in line_dedup.line_marks(pa.array(lines), 1, prints)[1][4:]), strict=True))
    linked = []
    for a in range(len(lines)):
        for b in range(a):
            if min(len(lines[a].split()), len(lines[b].split())) < min_words:
                continue
            if any(((x ^ y) % (1 << 64)).bit_count() <= max_bits for x, y in zip(fp[a], fp[b], strict=True)):
                longest = max(len(lines[a]), len(lines[b]))
                if slow_distance(lines[a], lines[b]) <= longest * (1 - similarity) + 1e-9:
                    linked.append((a, b))
    group = groups(range(len(lines)), linked)
    first = {}
    for k, line in enumerate(lines):
        first[group[k]] = min(first.get(group[k], (1 << 60, 0)), min(places[line]))
    gone = {p for k, line in enumerate(lines) for p in places[line] if p != first[group[k]]}
    return {
        key: None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (key, k) not in gone)
        for key, text in texts.items()
    }


@pytest.mark.parametrize("most, prints, short", [(4096, 1, False), (4, 3, False), (line_dedup.MOST, line_dedup.PRINTS, True)])
def test_lines_against_all_pairs(spark, most, prints, short):
    rng = random.Random(8)
    lines = near_texts(9, 120) + ["", "short line", "Tail, END of It: ok now"]
    texts = {k: "\n".join(rng.choices(lines, k=rng.randint(0, 9))) for k in range(1, 50)}
    got = line_dedup.dedup_lines(docs(spark, *texts.values()), most=most, prints=prints, short=short).collect()
    assert {r.doc_id: r.text for r in got} == slow_lines(texts, prints=prints, short=short)


def test_pairs_compared_one_by_one_and_many_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    bits = np.sort(np.unique(rng.integers(0, 1 << 12, 700, dtype=np.uint64) << np.uint64(8)))
    expected = {(a, b) for a in range(len(bits)) for b in range(len(bits)) if a != b and int(bits[a] ^ bits[b]).bit_count() <= 3}
    for leaf, wide, lot in ((8, 1, 64), (1 << 17, 1 << 10, 1 << 20), (1 << 30, 1 << 10, 999), (64, 1 << 30, 50)):
        for name, value in (("LEAF", leaf), ("WIDE", wide), ("LOT", lot)):
            monkeypatch.setattr(simhash, name, value)
        got = []
        simhash.trie_join(np.zeros(len(bits), np.int64), bits, 0, 3, lambda a, b, got=got: got.extend(zip(a.tolist(), b.tolist(), strict=True)))
        got += [(b, a) for a, b in got]
        assert set(got) == expected


def test_like_lines_are_one(spark):
    base = "the white whale swam far out into the cold northern sea and nobody saw it come back again " * 3
    texts = [base, base.replace("cold", "gold"), base.upper() + "!!", "the white whale", "the white whale\nnew words here"]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs(spark, *texts)).collect()}
    assert [got[k].text for k in (1, 2, 3, 4, 5)] == [texts[0], "", "", texts[3], texts[4]]
    assert (got[3].n_lines, got[3].n_removed, got[4].n_removed) == (1, 1, 0)


def test_lines_of_odd_rows(spark):
    got = line_dedup.dedup_lines(odd(spark))
    rows = got.collect()
    assert len(rows) == len(ROWS) and sorted(got.columns) == sorted(odd(spark).columns)
    by = {r.doc_id: r for r in rows}
    assert by[2].text is None and by[3].text == "" and by[5].text == "x" * 60_000
    assert by[6].text.strip("\n") == "" and by[6].n_removed == 800 and by[11].n_removed == 2
    assert by[1].n_removed == 0 and [r.text for r in rows if r.doc_id == 7] == ["", ""]
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def replaced(rng, vocabulary, words):
    """A line of so many words, and it with one of them replaced."""
    base = rng.choices(vocabulary, k=words)
    copy = list(base)
    copy[rng.randrange(words)] = rng.choice(vocabulary)
    return " ".join(base), " ".join(copy)


def test_candidates_by_line_length(spark):
    """One word replaced: all that is removed is alike by edit similarity, and more SimHashes find more of it."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrst", k=rng.randint(3, 8))) for _ in range(3000)]
    pairs = [replaced(rng, vocabulary, n) for n in (10, 30, 60) for _ in range(40)]
    texts = [line for pair in pairs for line in pair]
    alike = [a != b and line_dedup.alike(a, b) for a, b in pairs]
    share = {}
    for prints in (1, 4):
        left = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs(spark, *texts), prints=prints).collect()}
        assert not any(left[2 * k + 1] for k in range(len(pairs)))
        found = [left[2 * k + 2] for k in range(len(pairs))]
        assert all(a or not f for a, f in zip(alike, found, strict=True))
        share[prints] = [sum(found[k : k + 40]) / 40 for k in (0, 40, 80)]
    assert all(many >= one for one, many in zip(share[1], share[4], strict=True))
    assert share[4][1] >= 0.8 and share[4][2] >= 0.95


def test_own_columns_of_an_input_do_not_clash(spark):
    line = "the white whale swam far out into the cold northern sea"
    frame = docs(spark, line, line).withColumns({c: F.lit("own") for c in ("__gone", "__key", "__body", "c0", "n_lines")})
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame).collect()}
    assert got[1].text == line and got[2].text == "" and got[2]["__gone"] == got[2]["c0"] == "own"


def test_rows_of_one_key_lose_their_own_lines_only(spark):
    shared = "the white whale swam far out into the cold northern sea"
    own = ["bright amber lanterns hung above every narrow street", "seven grey mules carried salt across that pass"]
    tail = "but turned round twice before the dawn"
    rows = [(1, shared)]
    rows += [(key, f"{line}\n{line.upper()} {tail} {k}\nshort") for key in (None, 4) for k, line in enumerate([shared, *own])]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    left = [x for r in got for x in r.text.split("\n") if x and x != "short"]
    # No line of key 4 is lost through another row of it; those without key come last and go.
    assert sorted(left) == sorted([shared, f"{shared.upper()} {tail} 0", *own, *(f"{x.upper()} {tail} {k}" for k, x in enumerate(own, 1))])
    assert {r.n_removed for r in got if r.doc_id is None} == {2}


def test_short_and_unspaced_lines(spark):
    chinese = "大白鲸游进寒冷的北方海洋再也没有人见过它回来"
    texts = [f"Read more\n{chinese}\n--\nthe end", f"{chinese}\nread MORE!\n--\nthe und", chinese.replace("寒", "温")]
    frame = docs(spark, *texts)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, short=True).collect()}
    # A line without spaces is one word to SimHash: equal ones go, like ones stay.
    assert got == {1: texts[0], 2: "--\nthe und", 3: texts[2]}
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert kept[2] == "read MORE!\n--\nthe und"


def test_rows_move_once_to_their_block_values(spark):
    """The few large block values are broadcast, so the rows are shuffled for the join of tries only."""
    values = spark.range(20_000).select(F.xxhash64("id").alias("simhash")).unionByName(spark.range(9).select(F.col("id").alias("simhash")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        dealt = simhash.deal(values, max_bits=2, most=4)
        plan = dealt._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    parts = {}
    for r in dealt.where("simhash between 0 and 8 or simhash % 500 = 0").collect():
        parts.setdefault(r.simhash, set()).add((r.trie, r.part))
    assert len(parts) > 9
    # Every two values that agree on a block meet in one of its parts.
    cuts = [(64 - a - w, (1 << w) - 1) for a, w in simhash.blocks_of(2)]
    for a in parts:
        for b in parts:
            if any((a >> s) & m == (b >> s) & m for s, m in cuts):
                assert parts[a] & parts[b]


def test_distinct_lines_are_summed_without_sorting(spark):
    """Of a repeated line the first place stays, though the least line number and the least hash of a text are in other places."""
    line = "the white whale swam far out into the cold northern sea"
    rows = [(9, f"{line}\nnine"), (3, f"a\nb\n{line}"), (None, line), (5, f"five\n{line}\n{line}"), (3, f"x\n{line}")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = min((k, b, n) for k, b, n in ((r.doc_id, r.b, r.text.split("\n").index(line)) for r in frame.where("doc_id = 3").withColumn("b", F.xxhash64("text")).collect()))
    got = line_dedup.dedup_lines(frame).withColumn("n", F.col("n_lines") - F.col("n_removed")).collect()
    left = [r for r in got if line in r.text]
    assert len(left) == 1 and left[0].doc_id == 3 and left[0].text.split("\n").index(line) == expected[2]
    assert sum(r.n_removed for r in got) == 5
    marked = line_dedup.marked_lines(frame, "doc_id", "text", 5, short=True)
    assert {(r.print0 is None) for r in marked.collect()} == {True, False}
    least = marked.groupBy("high", "low").agg(*(F.min(c) for c in ("key", "body", "line", "print0")), F.count("*"))
    plan = least._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_distinct_words_and_normal_lines_at_once():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    for n in (0, 1, 700):
        owner = np.sort(rng.integers(0, 50, n))
        values = rng.choice(np.append(rng.integers(0, 2**64 - 1, 9, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)), n)
        got, of = line_dedup.distinct_in(owner, values)
        assert (np.diff(of) >= 0).all() and len(got) == len(set(zip(owner.tolist(), values.tolist())))
        assert set(zip(of.tolist(), got.tolist())) == set(zip(owner.tolist(), values.tolist()))
    lines = ["", "--", " The  END. of IT", "É\u00a0x 大白鲸", "one", "a" * 70_000]
    assert line_dedup.normals(pa.array(lines)).to_pylist() == ["", "", "the end of it", "É\u00a0x 大白鲸", "one", "a" * 70_000]
    assert line_dedup.normals(pa.array([], pa.string())).to_pylist() == []
