import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from llm.odd import docs, empty, odd
from lexiquarry.llm import fingerprints, pii

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def shingles(text, n=5):
    words = WORDS.findall(text.lower())
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def texts(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(500)]
    return [" ".join(rng.choices(words, k=rng.choice([0, 1, 4, 5, 60, 400]))) for _ in range(n)]


def test_whole_sketches_are_exact():
    """With every hash kept, containment and merging are those of the shingle sets."""
    some = texts(1, 12) + ["A b", "a B!", "a b c d e f"]
    sketch = [fingerprints.sketches([t], scale_bits=0)[0] for t in some]
    for a, s in zip(some, sketch, strict=True):
        assert len(s) == len(shingles(a))
        for b, o in zip(some, sketch, strict=True):
            if shingles(a) and a != b:
                exact = len(shingles(a) & shingles(b)) / len(shingles(a))
                assert fingerprints.containment(s, o, False) == pytest.approx(exact)
                both = fingerprints.read(fingerprints.merged(fingerprints.written(s), fingerprints.written(o)))
                assert len(both) == len(shingles(a) | shingles(b))


def test_estimates_are_near(spark):
    base = texts(3, 40)
    long = [t for t in base if len(t) > 2000]
    for t in long:
        half = t[: len(t) // 2]
        a, b = fingerprints.sketches([half, t + " " + long[0]])
        assert abs(fingerprints.containment(a, b, False) - 1) < 0.03
        assert abs(len(a) / len(shingles(half)) - 0.25) < 0.15


@pytest.mark.parametrize("tasks", ["3", "11"])
def test_against_the_sorted_list(spark, tasks):
    some = texts(5, 70)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        got = {r.doc_id: r for r in fingerprints.compare_next(docs(spark, *some).repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(range(1, 71), reverse=True)
    assert sorted(got) == sorted(order)
    for k, key in enumerate(order):
        text, following = some[key - 1], some[order[(k + 1) % 70] - 1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (fingerprints.sketches([t])[0] for t in (text, edited, following))
        assert r.fingerprint == fingerprints.written(a) and r.edited_fingerprint == fingerprints.written(b)
        assert r.near_edited == fingerprints.containment(a, b, text == edited)
        assert r.near_next == fingerprints.containment(a, c, text == following)


def test_fingerprints_of_odd_rows(spark):
    got = fingerprints.compare_next(odd(spark)).collect()
    assert len(got) == 13 and len([r for r in got if r.doc_id is None]) == 2
    assert {r.near_next for r in got if r.doc_id == 7 and r.near_next == 1} == {1.0}
    same = [r.fingerprint for r in got if r.doc_id in (1, 7)]
    assert len(set(same)) == 1
    assert fingerprints.compare_next(empty(spark)).count() == 0
    alone = fingerprints.compare_next(docs(spark, "red sea")).collect()
    assert [(r.near_next, r.doc_id) for r in alone] == [(1.0, 1)]
    assert fingerprints.fingerprints(odd(spark)).count() == 13


VALUES = {
    "card": "4111 1111 1111 1111", "plain card": "4111111111111111", "long card": "6304000000000000125",
    "phone": "+1 (826) 555-4081", "local phone": "(212) 555-0100", "ip": "233.254.104.120", "small ip": "1.43.173.5",
    "ssn": "123-45-6789", "iso": "1999-12-31", "us date": "02/29/2000", "de date": "31.01.1980", "uk date": "31/12/2024",
    "iban": "DE89 3704 0044 0532 0130 00", "plain iban": "GB82WEST12345698765432",
    "key": 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "upper key": "KEY:9233A8ECF7C5B09FE5949719B6B82BC439E9329B",
    "mail": "34@mail7.example.com", "named mail": "john.smith@x.org",
}
LEFT = ["version 3.", "CC BY-NC 4.0", "year 1999", "a 12345", "2023-02-30", "1850-01-01", "300.1.1.1", "000-12-3456", "x@y", "9807915762804490", "4111 1111 1111 1112",
        "commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "...@", "@x.org"]


def luhn_ok(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def iban_ok(text):
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


def test_values_are_replaced_in_their_format(spark):
    frame = docs(spark, *(f"before {v}, after" for v in VALUES.values()))
    got = [r.text for r in pii.pseudonymise(frame, "k").orderBy("doc_id").collect()]
    new = dict(zip(VALUES, (t.removeprefix("before ").removesuffix(", after") for t in got), strict=True))
    for name, value in VALUES.items():
        assert new[name] != value, name
        if "ip" not in name and "key" not in name:
            assert shape(new[name]) == shape(value), name
    assert luhn_ok(new["plain card"]) and new["card"].replace(" ", "") == new["plain card"]
    assert luhn_ok(new["long card"])
    assert iban_ok(new["iban"]) and iban_ok(new["plain iban"]) and new["iban"].startswith("DE")
    assert all(0 <= int(x) <= 255 for x in new["ip"].split("."))
    assert re.fullmatch("KEY:[0-9A-F]{40}", new["upper key"]) and re.fullmatch('token = "[0-9a-f]{40}"', new["key"])
    assert new["named mail"].endswith("@x.org")
    dates = spark.createDataFrame([(new["iso"],)], "d string").select(F.try_to_date("d")).first()[0]
    assert dates is not None and 1900 <= dates.year < 2100


def test_round_trip_and_links(spark):
    text = " | ".join(VALUES.values()) + "\n" + " ".join(VALUES.values())
    once = pii.pseudonymise(docs(spark, text, *VALUES.values()), "k")
    rows = once.orderBy("doc_id").collect()
    first, second = rows[0].text.split("\n")
    assert first.replace(" | ", " ") == second
    assert [r.text for r in rows[1:]] == first.split(" | ")
    back = [r.text for r in pii.restore(once.select("doc_id", "text"), "k").orderBy("doc_id").collect()]
    assert back == [text, *VALUES.values()]
    other = pii.pseudonymise(docs(spark, *VALUES.values()), "another").orderBy("doc_id").collect()
    assert all(a.text != b.text for a, b in zip(rows[1:], other, strict=True))


def test_what_is_not_valid_stays(spark):
    frame = docs(spark, *LEFT)
    rows = pii.pseudonymise(frame, "k").orderBy("doc_id").collect()
    assert [r.text for r in rows] == LEFT and not any(r.n_values for r in rows)


def test_permutations_of_small_domains(spark):
    """Every value is hit once."""
    pairs = spark.range(91).select(
        pii.feistel((F.col("id") / 13).cast("long"), F.col("id") % 13, F.lit(7), F.lit(13), "k", "t", False).alias("p")
    )
    assert sorted((r.p.a, r.p.b) for r in pairs.collect()) == [(a, b) for a in range(7) for b in range(13)]
    digits = spark.range(1000).select(
        pii.permute_digits(F.lpad(F.col("id").cast("string"), 3, "0"), 10, "k", "t", False).alias("d")
    )
    assert sorted(r.d for r in digits.collect()) == [f"{k:03d}" for k in range(1000)]
    for first, size, m, n in pii.DATE_SPANS:
        assert m * n == size
        days = spark.range(size).select(F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias("d"))
        new = days.select(pii.day(F.col("d"), "k", False).alias("n")).distinct()
        ends = new.agg(F.count("n"), F.min("n").cast("string")).first()
        assert tuple(ends) == (size, first)


def test_plan_is_native_and_does_not_shuffle(spark):
    plan = pii.pseudonymise(odd(spark), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_pii_of_odd_rows(spark):
    got = pii.pseudonymise(odd(spark), "k")
    before = {(r.doc_id, r.text) for r in odd(spark).collect()}
    assert {(r.doc_id, r.text) for r in got.collect()} == before
    assert got.columns.count("n_values") == 1 and got.count() == 13
    assert pii.pseudonymise(empty(spark), "k").count() == 0
    clashing = docs(spark, "1999-12-31").withColumns({c: F.lit("own") for c in ("__new", "new", "c0", "n_values")})
    row = pii.pseudonymise(clashing, "k").first()
    assert row["__new"] == row["new"] == row["c0"] == "own" and row["n_values"] == 1


def plain_values(rng):
    """Values with what plain Python says of them: whether they are valid, and so must change."""
    n = rng.choice([13, 15, 16, 19])
    number = "".join(rng.choice("0123456789") for _ in range(n))
    y, m, d = rng.randint(1890, 2110), rng.randint(0, 14), rng.randint(0, 33)
    try:
        day = datetime.date(y, m, d)
    except ValueError:
        day = None
    area, group, serial = rng.choice([0, 1, 665, 666, 667, 899, 900, 123]), rng.choice([0, 7, 99]), rng.choice([0, 1, 9999])
    octets = [rng.randint(0, 300) for _ in range(4)]
    body = "".join(rng.choice("0123456789") for _ in range(18))
    check = 98 - int(body + "1314" + "00") % 97
    name = "".join(rng.choice("abcXYZ._-+019") for _ in range(rng.randint(1, 9)))
    wrong = rng.random() < 0.5
    yield number, luhn_ok(number)
    yield f"{y:04d}-{m:02d}-{d:02d}", day is not None and 1900 <= y < 2100
    yield f"{area:03d}-{group:02d}-{serial:04d}", area not in (0, 666) and area < 900 and group > 0 and serial > 0
    yield ".".join(map(str, octets)), max(octets) <= 255
    yield f"DE{(check + wrong) % 100:02d}{body}", iban_ok(f"DE{(check + wrong) % 100:02d}{body}")
    yield f"{name}@mail.example.org", any(c.isalnum() for c in name)


def test_finding_and_validating_against_plain_python(spark):
    rng = random.Random(6)
    values = [v for _ in range(120) for v in plain_values(rng)]
    rng.shuffle(values)
    texts = [" ; ".join(v for v, _ in values[k : k + 6]) for k in range(0, len(values), 6)]
    rows = pii.pseudonymise(docs(spark, *texts), "k").orderBy("doc_id").collect()
    changed = [a != b for row, text in zip(rows, texts, strict=True) for a, b in zip(row.text.split(" ; "), text.split(" ; "), strict=True)]
    # A permutation may give back the value it was given, but hardly ever does.
    differ = [(v, c) for (v, valid), c in zip(values, changed, strict=True) if c != valid]
    assert all(not c for _, c in differ) and len(differ) <= 8, differ
    assert [r.n_values for r in rows] == [sum(changed[k : k + 6]) for k in range(0, len(changed), 6)]


def test_a_long_run_of_letters_takes_linear_time(spark):
    import time

    texts = ["a" * 5_000_000 + " x@y", "a.-" * 1_000_000 + " x@y", "@" + "a@" * 500_000, "x@" + "a.b-" * 500_000]
    start = time.perf_counter()
    rows = pii.pseudonymise(docs(spark, *texts[:3]), "k").collect()
    assert time.perf_counter() - start < 60 and [r.n_values for r in rows] == [0, 0, 0]
