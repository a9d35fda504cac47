import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.odd import docs, empty, odd
from lexiquarry.llm import html_blocks, html_extraction, html_training, language, quality

LETTERS = {"en": "etaoinshrdlu", "fi": "aäitnesloökuy", "ru": "оеаинтсрвлкм"}


def sentences(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    words = ["".join(rng.choices(LETTERS[lang], k=rng.randint(2, 9))) for _ in range(n)]
    return " ".join(w.capitalize() if k % 9 == 0 else w for k, w in enumerate(words)) + ". 12!"


def corpus(spark, each=40):
    rows = [(lang, sentences(lang, 30, k)) for k in range(each) for lang in LETTERS]
    return spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string")


def slow_vector(text, space):
    """A text's bundle of bound letter vectors, letter by letter."""
    clean = "".join(c.lower() if c.isalpha() else " " for c in text)
    clean = " " + " ".join(clean.split()) + " "
    out = np.zeros(space.dimensions)
    for k in range(len(clean) - 2):
        bound = np.ones(space.dimensions)
        for place, c in enumerate(clean[k : k + 3]):
            bound = bound * np.roll(language.vector(ord(c), space.dimensions), 2 - place)
        out += bound
    return out


@pytest.mark.parametrize("kept", [40_000, 10])
def test_bundles_letter_by_letter(kept):
    space = language.Space(64, kept=kept)
    texts = ["The  sea, 7 whales!", "x", "Ébène Öl", "a-b", "ЁЖ и мир"]
    got, lettered = space.texts(pa.array([*texts, "", None, "12 ?"]))
    for row, text in zip(got, texts, strict=False):
        slow = slow_vector(text, space)
        cosine = (row @ slow) / np.sqrt((row @ row) * (slow @ slow))
        assert cosine > 0.99, text
    assert lettered.tolist() == [True] * 5 + [False] * 3


def test_languages_are_told_apart(spark):
    frame = corpus(spark)
    names, prototypes = language.fit(frame.where(language.learns()))
    assert names == ["en", "fi", "ru"]
    got = language.identify(frame.where(~language.learns()), names, prototypes).collect()
    assert len(got) > 15 and all(r.lang_pred == r.lang and 0 < r.score <= 1 for r in got)


def test_fit_does_not_depend_on_partitions(spark):
    frame = corpus(spark, 10)
    one, other = language.fit(frame.repartition(1)), language.fit(frame.repartition(7))
    assert one[0] == other[0] and (one[1] == other[1]).all()


def test_language_of_odd_rows(spark):
    names, prototypes = language.fit(corpus(spark, 10).unionByName(odd(spark).select("doc_id", "text", "lang")))
    assert names == ["de", "en", "fi", "ru"]
    got = language.identify(odd(spark), names, prototypes)
    rows = got.collect()
    assert len(rows) == 13 and len(got.columns) == len(set(got.columns))
    unknown = [r for r in rows if r.lang_pred == "und"]
    assert sorted((r.doc_id or 0) for r in unknown) == [0, 2, 3, 4, 9] and all(r.score == 0 for r in unknown)
    assert language.identify(empty(spark), names, prototypes).count() == 0
    none = language.fit(empty(spark))
    assert none[0] == [] and {r.lang_pred for r in language.identify(odd(spark), *none).collect()} == {"und"}


def test_held_out_rows_are_those_of_the_rule(spark):
    frame = spark.range(40).select(F.col("id").alias("doc_id"))
    for module, number, rest in ((language, 4, 2), (quality, 5, 0)):
        held = {r.doc_id for r in frame.where(~module.learns()).collect()}
        assert held == {k for k in range(40) if zlib.crc32(str(k).encode()) % number == rest}


def labelled(spark, n=160):
    rows = []
    for k in range(n):
        text = sentences("en", 40, k)
        rows.append((k, text if k % 4 else text.upper().replace(" ", "!! "), int(k % 4 > 0)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, label int")


def test_quality_of_held_out_rows(spark):
    frame = labelled(spark)
    model = quality.fit(frame.where(quality.learns()))
    got = quality.score(frame.where(~quality.learns()), model).collect()
    assert len(got) > 20
    assert np.mean([r.predicted == r.label for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_sampled_labels_are_bounded_and_balanced(spark):
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 > 0).cast("int").alias("label"))
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (5000, None)], "doc_id bigint, label int"))
    got = quality.sampled(labels, rows=200).collect()
    assert sum(r.label for r in got) == 100 and len(got) == 200
    assert {r.doc_id for r in got} == {r.doc_id for r in quality.sampled(labels.repartition(5), rows=200).collect()}
    assert quality.sampled(labels, rows=100_000).count() == 3000


def test_dual_descent_reaches_the_optimum():
    """The primal objective is near what plain subgradient steps reach."""
    rng = np.random.default_rng(1)
    x = [np.unique(rng.integers(0, 30, 8)) for _ in range(60)]
    y = np.where([v[0] < 2 for v in x], 1, -1)
    ratio = rng.normal(size=30)
    weights, bias = quality.descend(x, y, ratio, rounds=400)
    rows = np.zeros((60, 31))
    for k, v in enumerate(x):
        rows[k, v], rows[k, 30] = ratio[v] / np.sqrt(len(v)), 1

    def value(w):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (rows @ w)).sum()

    slow = best = np.zeros(31)
    for step in range(1, 20_000):
        late = (y * (rows @ slow) < 1) * y
        slow = slow - (slow - late @ rows) / (step + 20)
        best = min(best, slow, key=value) if step % 50 == 0 else best
    assert value(np.append(weights, bias)) <= value(best) * 1.005


def test_quality_of_odd_rows(spark):
    model = quality.fit(labelled(spark, 60))
    got = quality.score(odd(spark), model).collect()
    assert len(got) == 13 and len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert quality.score(empty(spark), model).count() == 0
    one = quality.fit(labelled(spark, 40).where("label = 1"))
    assert {r.score for r in quality.score(odd(spark), one).collect()} == {1.0}
    none = quality.fit(labelled(spark, 4).where("false"))
    assert {r.score for r in quality.score(odd(spark), none).collect()} == {0.5}
    doubtful = labelled(spark, 20).withColumn("label", F.when(F.col("doc_id") > 5, F.col("label")))
    assert quality.score(odd(spark), quality.fit(doubtful)).count() == 13


def test_grams_are_sets_of_one_text_each():
    rows, buckets = quality.grams(pa.array(["red sea", None, "red sea red sea", "", "Red sea."]))
    sets = [set(buckets[rows == k].tolist()) for k in range(5)]
    assert not sets[1] and not sets[3] and sets[0] < sets[2]
    assert sets[0] != sets[4] and len(buckets) == sum(map(len, sets))


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style></head><body>
<nav class="main-menu"><ul><li><a href="/">Home</a><li><a href=/x>News</a></ul></nav>
<!-- <p>no</p> --><script>var a = "<p>no</p>";</script>
<article><h1>A &lt;big&gt;
   day</h1><p><b>One &amp; two<br>three &eacute;<p class=x>Four <a href="#">five</a> six</p>
<div class="ad">Buy</div></article><footer>&copy; me <p>Last"""


def test_blocks_of_a_page():
    found = html_blocks.blocks(PAGE)
    assert [b.text for b in found] == [
        "Home", "News", "A <big> day", "One & two three é", "Four five six", "Buy", "© me", "Last",
    ]
    assert found[0].path[2] == "nav main menu" and found[0].linked == 1 and found[4].path[-1] == "p x"
    assert 0 < found[4].linked < 1 and found[5].path[-1] == "div ad"


@pytest.mark.parametrize("page", [None, "", " \n", "<", "<p", "<p>a</div></p></p>b</html>", "<!-- x", "<script>x", "a<br>b", "&am", "</p>" * 300, "<b>" * 500 + "x"])
def test_broken_pages(page):
    for block in html_blocks.blocks(page):
        assert block.text == " ".join(block.text.split())
    texts = {"a<br>b": ["a b"], "&am": ["&am"], "<p>a</div></p></p>b</html>": ["a", "b"]}
    if page in texts:
        assert [b.text for b in html_blocks.blocks(page)] == texts[page]


@pytest.mark.parametrize(
    "page, texts",
    [
        ("<article><p title=don't>First.</p><p>Second.</p><p>Third it's.</p></article>", ["First.", "Second.", "Third it's."]),
        ('<p class="x"">First</p><p>Next</p>', ["First", "Next"]),
        ("<!-- x --!><p>a</p><!--><p>b</p><!---><p>c</p><!-- y --><p>d</p>", ["a", "b", "c", "d"]),
        ("<p a=>x</p><p =a>y</p><p a b=1c=2>z</p>", ["x", "y", "z"]),
        ("<p title='a > b'>one</p><p title=\"c > d\"e>two</p><img alt=a>b/><p/class=x>three", ["one", "two", "b/>", "three"]),
        ("<p>a</p><p title=\"never closed>b</p><p>c</p>", ["a"]),
        ("<b>x<i>y</b>z</i></b></i>w", ["xyzw"]),
        ("<div title = 'it' hidden class = q>x</div>", ["x"]),
    ],
)
def test_attributes_and_comments_as_browsers_read_them(page, texts):
    assert [b.text for b in html_blocks.blocks(page)] == texts


def test_names_of_attributes_out_of_order():
    (block,) = html_blocks.blocks("<div class=side-bar it's id='Main' hidden role=x\"y>t</div>")
    assert block.path == ("div side bar main hidden x y",)
    assert html_blocks.blocks('<div class="side-bar" id=Main hidden>t</div>')[0].path == ("div side bar main hidden",)


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 200_000 + "</i>" * 200_000 + "x",
        "<div>" * 50_000 + "<p>a</p>" * 20_000,
        "<div>" * 20_000 + "<ul class=a><p>a</p></ul>" * 20_000,
        "<b>" * 100_000 + "<p>a</p>" * 100_000,
        "<div class=a>x" * 100_000,
        "<i><b>" * 100_000 + "</b></i>" * 100_000,
        "<p " + "a" * 200_000 + "'" * 200_000 + " " * 200_000,
        "<a href='x" * 100_000,
        "<!--" + "-" * 200_000 + "<!-" * 50_000,
        "</p>" * 200_000,
    ],
)
def test_long_broken_pages_take_linear_time(page):
    import time

    start = time.perf_counter()
    found = html_blocks.blocks(page)
    if found:
        html_extraction.vectors([found[:20_000]])
    assert time.perf_counter() - start < 15


def test_gradients_by_small_steps():
    rng = np.random.default_rng(2)
    model = html_extraction.Labeller(hidden=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    pages = [(rng.normal(size=(n, html_extraction.INPUT)) / 9, rng.integers(0, 2, n)) for n in (4, 2)]
    x, live, y = (a.astype(np.float64) if a.dtype != bool else a for a in html_extraction.padded(pages))

    def loss():
        z = model.logits(x, live)
        return (np.logaddexp(0, z) - y * z)[live].sum() / live.sum()

    for name, g in model.gradients(x, live, y).items():
        place = tuple(int(rng.integers(n)) for n in g.shape)
        kept = model.weights[name][place]
        ends = []
        for step in (1e-4, -1e-4):
            model.weights[name][place] = kept + step
            ends.append(loss())
        model.weights[name][place] = kept
        assert (ends[0] - ends[1]) / 2e-4 == pytest.approx(g[place], abs=2e-4)


@pytest.fixture(scope="module")
def labeller():
    pages = html_extraction.training_pages([sentences("en", 60, k) for k in range(40)], 900)
    return html_extraction.Labeller().train([(html_extraction.vectors([b]), y) for _, b, y in pages])


def test_set_pages_match_their_labels():
    setter = html_training.Setter([sentences("fi", 60, k) for k in range(5)], 3)
    same = 0
    for _ in range(200):
        page, labels = setter.page()
        same += len(html_blocks.blocks(page)) == len(labels)
    assert same >= 190


def test_held_out_layouts(labeller):
    pages = html_extraction.training_pages([sentences("fi", 60, k) for k in range(40)], 150, seed=8)
    right = [
        (labeller.label([html_extraction.vectors([b])])[0] >= 0.5) == (y > 0) for _, b, y in pages
    ]
    assert np.concatenate(right).mean() > 0.97


def test_pages_together_are_as_each_alone(labeller):
    pages = [html_extraction.vectors([b]) for _, b, _ in html_extraction.training_pages(["a b c d e f g"], 30, seed=2)]
    pages.insert(3, html_extraction.vectors([[]]))
    together = labeller.label(pages, most=100)
    for one, page in zip(together, pages, strict=True):
        assert np.allclose(one, labeller.label([page])[0], atol=1e-5)


def test_extraction_of_odd_pages(spark, labeller):
    frame = spark.createDataFrame(
        [(1, PAGE, "u", "own"), (2, None, None, "own"), (3, "", "u", "own"), (1, PAGE, "u", "own"), (None, "<nav><ul><li><a href='/'>x</a></ul></nav>", "u", "own")],
        "page_id bigint, html string, url string, n_chars string",
    )
    got = html_extraction.extract(frame, labeller).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[2] == by[3] == "" and "Four five six" in by[1] and "Home" not in by[1] and "Buy" not in by[1]
    assert html_extraction.extract(frame.where("false"), labeller).count() == 0
    small = html_extraction.fit(frame, sample=3, train=20)
    assert html_extraction.fit(frame.where("false"), train=5) is not None
    assert html_extraction.extract(frame, small).count() == 5


def test_scores_answer_for_the_shares_of_all_labels(spark, monkeypatch):
    """A balanced sample is calibrated to the shares of all labelled rows."""
    frame = spark.createDataFrame([(k, sentences("en", 30, k), int(k % 10 > 0)) for k in range(800)], "doc_id bigint, text string, label int")
    labels = frame.select("doc_id", "label")
    many = quality.totals(labels.unionByName(spark.createDataFrame([(None, 1), (9000, None)], "doc_id bigint, label int")))
    assert many == (80, 720)
    sample = quality.sampled(labels, rows=120, many=many)
    assert sample.where("label = 1").count() == 60
    training, asked, plain = frame.drop("label").join(sample, "doc_id"), [], quality.fit_margin
    monkeypatch.setattr(quality, "fit_margin", lambda x, y, ratio, many: asked.append(tuple(many)) or plain(x, y, ratio, many))
    own, balanced = quality.fit(training, whole=many), quality.fit(training)
    assert asked == [(80, 720), (60, 60)]
    texts = pa.array([r.text for r in frame.collect()])
    assert own.scores(texts).mean() > balanced.scores(texts).mean()
    one = quality.fit(frame.where("label = 1"), whole=many)
    assert one.constant == 0.9


def test_long_texts_are_fitted_whole(spark, monkeypatch):
    """The rows of the fit have all n-grams that scoring uses, so both have one scale of margins."""
    texts = [" ".join(f"w{k}x{j * (k + 3) % 6007}" for j in range(2500)) for k in range(4)]
    frame = spark.createDataFrame([(k, t, k % 2) for k, t in enumerate(texts)], "doc_id bigint, text string, label int")
    asked, plain = [], quality.fit_margin
    monkeypatch.setattr(quality, "fit_margin", lambda x, y, ratio, many: asked.append(x) or plain(x, y, ratio, many))
    quality.fit(frame)
    size = np.bincount(quality.grams(pa.array(texts))[0])
    assert min(size) > 4096 and sorted(map(len, asked[0])) == sorted(size.tolist())
