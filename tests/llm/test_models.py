"""The trained operators: exact inference against plain versions, accuracy on held-out rows."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_data import edge_rows
from pyspark.sql import functions as F

from tarmac.llm import htmltext, quality, toxicity, wordhash
from tarmac.llm.queries import held_out, op1_quality, op8_toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    lengths = [1, 4, 2, 6]
    first = np.concatenate([[0], np.cumsum(lengths)])
    potential, transition = rng.normal(0, 1, first[-1]), rng.normal(0, 1, (2, 2))
    good, pairs = quality.marginals(potential, first, transition)
    for k, n in enumerate(lengths):
        u = potential[first[k] : first[k + 1]]
        total, one, two = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(u[t] for t in range(n) if y[t]) + sum(transition[a, b] for a, b in zip(y, y[1:])))
            total += w
            one += w * np.array(y)
            for a, b in zip(y, y[1:]):
                two[a, b] += w
        assert np.allclose(good[first[k] : first[k + 1]], one / total)
        assert np.allclose(pairs[k], two / total)


def test_lines_of_a_slice():
    texts = ["one line", "", "a\n\nb c", "\n", "x\n"]
    column = pa.array(texts)
    ((_, data, offsets),) = wordhash.text_slices(column)
    lines = quality.Lines(data, offsets)
    assert np.diff(lines.first).tolist() == [len(t.split("\n")) for t in texts]
    assert lines.length.tolist() == [max(1, len(x)) for t in texts for x in t.split("\n")]


def labelled(spark, kind):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    return labels.where(f"{kind} is not null").select("doc_id", F.col(kind).alias("label"))


def test_quality_of_held_out_documents(spark):
    found = op1_quality(spark, SF_DIR)
    both = found.where("held_out").join(labelled(spark, "quality"), "doc_id").toPandas()
    assert (both.predicted == both.label).mean() > 0.98
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_toxicity_of_held_out_documents(spark):
    found = op8_toxicity(spark, SF_DIR)
    both = found.where("held_out").join(labelled(spark, "toxic"), "doc_id").toPandas()
    toxic, clean = both[both.label == 1], both[both.label == 0]
    assert toxic.predicted.mean() > 0.9 and clean.predicted.mean() < 0.02


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_rows(spark, edges, empty, module, label):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 1), (99, 1), (None, 1), (3, None)], f"doc_id long, {label} int")
    for known in (labels, labels.limit(0)):
        model = module.train(edges, known)
        found = module.score(edges, model, ["doc_id"]).collect()
        assert len(found) == len(edge_rows())
        assert all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id == 4}) == 1
        assert module.score(empty, model, ["doc_id"]).count() == 0


@pytest.mark.parametrize("unit", ["lines", "words"])
def test_training_sample_is_bounded(spark, unit):
    docs = [(1, f"text {i % 3}") for i in range(300)] + [(2, "one two\n" * 50), (3, "three"), (4, None), (5, "six")]
    labels = [(1, 1)] * 200 + [(2, 0), (3, 1), (3, 0), (3, None), (4, 1), (None, 1), (9, 1)]
    sample = toxicity.training_sample(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, mark int"),
        "doc_id", "text", "mark", 4, {"lines": quality.line_count, "words": toxicity.word_count}[unit], 20,
    )
    found = sorted(tuple(r) for r in sample.collect())
    # One label and one text of each id; five ids are labelled, four of them have texts, one is too long.
    assert len(found) <= 4 and len({t for _, t in found}) == len(found)
    assert all(t.startswith("text") or t in ("", "three") for _, t in found)
    assert [y for y, t in found if t == "three"] in ([0], [])


def test_a_mixed_document_gets_mixed_lines(spark):
    """A line's label follows its own form and that of the lines beside it."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(~held_out(3, 1))
    field = quality.train(docs, labels)
    kinds = {k: [] for k in (0, 1)}
    marked = docs.join(labels.where("quality is not null"), "doc_id").orderBy("doc_id").limit(400)
    for r in marked.collect():
        kinds[r.quality] += [x for x in (r.text or "").split("\n") if len(x) > 80]
    rng = random.Random(2)
    good, bad = (rng.sample(kinds[k], min(60, len(kinds[k]))) for k in (1, 0))

    def lines(text):
        ((_, data, offsets),) = wordhash.text_slices(pa.array([text]))
        found = quality.Lines(data, offsets)
        return quality.marginals(field.potentials(found.x), found.first, field.transition)[0]

    mixed = lines("\n".join([*good[:20], *bad[:20], *good[20:40]]))
    assert mixed[:20].mean() > 0.7 > 0.3 > mixed[20:40].mean()
    among_good = [lines("\n".join([*good[:3], x, *good[3:6]]))[3] for x in bad[:20]]
    among_bad = [lines("\n".join([*bad[20:23], x, *bad[23:26]]))[3] for x in bad[:20]]
    assert np.mean(among_good) > np.mean(among_bad) + 0.01


def test_labels_train_alone(spark):
    labels = spark.createDataFrame([(i,) for i in range(40)], "doc_id long").where(~held_out(3, 1))
    import zlib

    assert {r.doc_id for r in labels.collect()} == {i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1}


def test_good_documents_stay_whole(spark, edges):
    model = quality.train(edges, spark.createDataFrame([], "doc_id long, quality int"))
    kept = quality.keep_good(edges, model)
    assert kept.columns == edges.columns and kept.count() == len(edge_rows())


def test_worst_sentence_and_noisy_or():
    texts = ["good day. bad word here! fine", "", "fine", "bad\nbad word"]
    ((_, data, offsets),) = wordhash.text_slices(pa.array(texts))
    s = toxicity.Sentences(data, offsets)
    model = toxicity.Model(np.zeros(1 << toxicity.BUCKET_BITS), -3.0)
    ((_, d, o),) = wordhash.text_slices(pa.array(["bad"]))
    model.weights[toxicity.Sentences(d, o).features[0]] = 5.0
    total, first, size, worst = toxicity._score_slice(model, data, offsets)
    p = lambda z: 1 / (1 + np.exp(-z))
    assert np.allclose(total, [1 - (1 - p(2)) * (1 - p(-3)) ** 2, 0, p(-3), 1 - (1 - p(2)) ** 2])
    assert texts[0].encode()[first[0] : first[0] + size[0]] == b"bad word here"
    assert first.tolist()[1] == -1 and len(s) == 6


def test_page_blocks():
    page = """<html><head><title>no</title><script>var t="</p>";</script></head><body><nav><ul><li>a<li>b</ul></nav>
    <article><h1>T&amp;C</h1><p>one <b>two<br>three<p class="x y">four&nbsp;&nbsp;five <!-- <p>no --> six
    <table><tr><td>c1<td>c2</table></article><p>1 < 2</body>"""
    found = htmltext.blocks(page)
    assert [t for _, t in found] == ["a", "b", "T&C", "one two three", "four five six", "c1", "c2", "1 < 2"]
    assert found[3][0] == ("html", "body", "article", "p", "b")
    assert found[4][0] == ("html", "body", "article", "p", "x", "y")
    assert found[5][0][-3:] == ("table", "tr", "td") and "p" not in found[5][0]


def test_page_blocks_of_open_head_and_odd_names():
    """An omitted </head>, names that begin like raw ones, and formulas lose no text."""
    texts = lambda page: [t for _, t in htmltext.blocks(page)]
    page = "<html><head><title>t</title><meta charset=x><body><article><p>one<p>two</article></body></html>"
    assert htmltext.blocks(page) == [(("html", "body", "article", "p"), t) for t in ("one", "two")]
    assert texts("<head><style>p {}</style><p>one") == ["one"]
    assert texts("<head/><p>one</p>") == ["one"]
    for name in ("title-bar", "object-card", "select-box", "head-line", "math-note", "svg-icon"):
        assert texts(f"<{name}>a</{name}><p>b</p>") == ["a", "b"], name
    formula = "<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds"
    assert texts(formula) == ["so x=1 holds"]
    assert texts("<svg width=1 /><p>one") == ["one"]
    assert texts("<svg><text>no</text></svg><script>no</script ><p>one") == ["one"]


def test_lstm_gradients():
    rng = np.random.default_rng(2)
    lengths = np.array([3, 1, 5])
    x = rng.normal(0, 1, (9, htmltext.INPUT))
    weights = rng.normal(0, 0.2, (htmltext.INPUT + htmltext.HIDDEN + 1, 4 * htmltext.HIDDEN))
    target = rng.normal(0, 1, (9, htmltext.HIDDEN))
    layout = htmltext.Layout(lengths)
    for backwards in (False, True):
        loss = lambda w: (htmltext.Lstm(w, backwards).forward(x, layout)[0] * target).sum()  # noqa: B023,E731
        lstm = htmltext.Lstm(weights, backwards)
        _, tape = lstm.forward(x, layout, keep=True)
        grad = lstm.backward(x, tape, target)
        for _ in range(25):
            i, j = rng.integers(weights.shape[0]), rng.integers(weights.shape[1])
            step = np.zeros_like(weights)
            step[i, j] = 1e-5
            assert np.isclose(grad[i, j], (loss(weights + step) - loss(weights - step)) / 2e-5, atol=1e-5)


@pytest.fixture(scope="module")
def labeller(spark):
    return htmltext.train(spark.read.parquet(f"{SF_DIR}/pages.parquet"))


def test_main_text_of_unseen_pages(spark, labeller):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").limit(400).collect()
    texts = htmltext.main_texts([r.html for r in pages], labeller)
    want = ["\n\n".join(t for path, t in htmltext.blocks(r.html) if htmltext.taught(path)) for r in pages]
    assert np.mean([a == b for a, b in zip(texts, want)]) > 0.98


def test_odd_pages(spark, labeller):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p"), (3, "u", "<article>" * 3000), (4, "u", "plain text"),
            (4, "u", "plain text"), (5, "u", "<script>x"), (6, "u", "<a href='x>y")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    found = htmltext.extract(pages, labeller, ["page_id", "url"]).collect()
    assert len(found) == len(rows) and all(r.text is not None for r in found)
    assert {r.text for r in found if r.page_id in (1, 2, 3, 5)} == {""}
    assert htmltext.extract(pages.limit(0), labeller, ["page_id"]).count() == 0
    untaught = htmltext.train(pages.limit(0))
    assert htmltext.extract(pages, untaught, ["page_id"]).count() == len(rows)


def test_pages_in_parts_are_labelled_alike(labeller, monkeypatch):
    rng = random.Random(4)
    page = "<html><body><nav><a>x</a></nav><article>" + "".join(
        f"<p>{' '.join(f'wort{rng.randrange(50)}' for _ in range(rng.randrange(1, 90)))}</p>" for _ in range(70)
    )
    pages = [page + "</article><footer>f</footer>", "", "<article><p>short</p></article>", page * 2]
    whole = [labeller.probabilities(htmltext.vectors(s), np.array([len(s)])) for s in map(htmltext.blocks, pages) if s]
    texts = htmltext.main_texts(pages, labeller)
    monkeypatch.setattr(htmltext, "STEP_BLOCKS", 16)
    parts = [labeller.long_probabilities(s) for s in map(htmltext.blocks, pages) if s]
    assert all(np.allclose(a, b) for a, b in zip(whole, parts))
    assert htmltext.main_texts(pages, labeller) == texts


def test_every_word_of_a_long_block_counts():
    words = [f"w{k}" for k in range(200)]
    base = htmltext.vectors([(("p",), " ".join(words))])
    for k in range(0, 200, 7):
        changed = htmltext.vectors([(("p",), " ".join([*words[:k], "other-word", *words[k + 1 :]]))])
        same = htmltext._slot(words[k], htmltext.WORD_SIZE, 0) == htmltext._slot("other-word", htmltext.WORD_SIZE, 0)
        assert same or not np.allclose(base[0, : htmltext.PATH_SIZE + htmltext.WORD_SIZE], changed[0, : htmltext.PATH_SIZE + htmltext.WORD_SIZE])


def test_long_page_keeps_all_paragraphs(labeller):
    rng = random.Random(3)
    body = [" ".join(f"wort{rng.randrange(900)}" for _ in range(30)) + "." for _ in range(3000)]
    page = "<html><body><nav><a>x</a></nav><article><h1>T</h1>" + "".join(f"<p>{b}</p>" for b in body)
    (text,) = htmltext.main_texts([page + "</article><footer>f</footer></body></html>"], labeller)
    assert text == "\n\n".join(["T", *body])


