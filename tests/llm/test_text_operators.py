"""Quality rules, token counts and HTML extraction."""

import re
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from crashlens.llm import html_mincut as H
from crashlens.llm import token_counts as T
from crashlens.llm.quality import SYMBOLS, Rule, quality_flags
from tests.llm.conftest import pairs

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _quality(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text) if x]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_measures_by_brute_force(odd, small):
    for docs in (odd, small):
        got = quality_flags(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
        want = sorted(((i, *_quality(t)) for i, t in pairs(docs)), key=str)
        assert sorted((tuple(r)[:6] for r in got), key=str) == want
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_quality_has_no_python_and_no_shuffle(odd):
    plan = quality_flags(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_rule_bounds_compile(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (9.0,)], "m double")
    assert [r[0] for r in df.select(Rule("m", 2, 6).holds()).collect()] == [False, True, False]


def test_quality_empty(empty):
    assert quality_flags(empty).collect() == []


def test_token_counts_match_the_library(odd, small, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for docs in (odd, small, empty):
        got = sorted((tuple(r) for r in T.token_counts(docs, MODEL).collect()), key=str)
        assert got == sorted(((i, len(t.encode()), len(model.encode(t))) for i, t in pairs(docs)), key=str)


def test_odd_texts_count_as_the_library():
    counter = T.Counter(T.prove(MODEL))
    for t in ("", " ", "  ", "\n", " \n ", "a\t b  c▁ d", "<s> </s> <0x0A> <unk>", "▁", " x　 y", "é \r\n 漢字 \U0001F600‍",
              "a" * 300 + " " * 70 + "b", "\x00 a", "ﬁ ½ Å", "\n\n  \n x"):
        assert counter.count(t) == len(counter.model.encode(t)), repr(t)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><div id="cookie-notice">We use cookies.</div>
<header><h1>Site</h1><a href=x>Home</a></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy.</div>
<article><h1>Title of it</h1><p>First <a href=x>link</a> &amp;  text&nbsp;here. <b>bold</b><p>Second para.<table><tr><td>cell</td></tr></table>
<aside>Side</aside><form>Sign <input></form><section class="comments"><p>A reader says hello.</p></section></article>
<div class="sidebar"><p>Popular posts.</p></div><script>x("</p>")</script><footer>foot</footer>"""


def test_main_text_of_a_page():
    assert H.main_text(PAGE) == "Title of it First link & text here. bold Second para. cell"


def test_odd_pages():
    assert H.main_text(None) == "" and H.main_text("") == "" and H.main_text("<div>") == ""
    assert H.main_text("just some words without a tag.") == "just some words without a tag."
    assert H.main_text("<p>one sentence here.<p>another one there.") == "one sentence here. another one there."
    assert H.main_text("</p></div><article>" + "<p>A sentence.</p>" * 5000) == " ".join(["A sentence."] * 5000)
    assert H.main_text("<article><p>open <b>bold</article> tail") != ""


def test_attributes_and_depth():
    assert H.main_text("<p>One <a title=don't>two</a> three.</p><p>It's four.</p><p>Five</p>") == "One two three. It's four. Five"
    assert H.main_text("""<p title="a > b" data-x='"'>Six is here.</p><p class = body id=x/>Seven is here.""") == "Six is here. Seven is here."
    assert H.main_text("<article><p>Some text.</p><p>a < b and c > d.</p></article>") == "Some text. a < b and c > d."
    deep = "<div>word " * 20000
    assert H.main_text(deep) == " ".join(["word"] * 20000)
    assert H.main_text("<b>x <i>" * 5000 + "</b></i>" * 5000 + "<p>A sentence to end with.") != ""


def test_the_cut_decides():
    """Shapes alone take an advert's sentence and leave the short lines of an article."""
    page = ("<div class=ad><p>Buy this very good thing of ours today, it is only sold here.</p></div>"
            "<article><h1>Title</h1><p>A sentence of the article that says something.</p><p><a href=x>More</a></p><p>Yes</p></article>")
    found = H.blocks(page)
    assert [H.cost(b, H.DEFAULT) > 0 for b in found] == [True, True, True, False, False]
    assert H.content_side(found) == [False, True, True, True, True]
    # without any mark a short line between sentences follows its neighbours
    plain = H.blocks("<p>A sentence to begin with, and some more.</p><p>Ja</p><p>Another sentence that goes on and on.</p>")
    model = H.Model(H.DEFAULT.weights, 1.0)
    assert H.cost(plain[1], model) < 0 and H.content_side(plain, model, marks=False) == [True] * 3


def test_cut_of_a_page_is_minimal():
    import itertools

    page = "<div class=ad>Buy.</div><article><p>First text.</p><section class=comments>I say.</section><p>x</p></article><div class=story>Tail</div>"
    found = H.blocks(page)
    scores, edges = H.graph(found, H.DEFAULT)

    def price(label):
        return sum(-s if s < 0 and x else s if s > 0 and not x else 0 for s, x in zip(scores, label)) + sum(c for a, b, c in edges if label[a] != label[b])

    best = min(itertools.product((False, True), repeat=len(scores)), key=price)
    assert list(best[:len(found)]) == H.content_side(found) == [False, True, False, True, True]


def test_costs_are_fitted(spark):
    """Half of a table's pages give the costs; the other half's text is found with the marks hidden."""
    rows = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    learn, rest = [H.blocks(h) for h in rows[::2]], [H.blocks(h) for h in rows[1::2]]
    model = H.fit(learn)
    assert model.weights != H.DEFAULT.weights and model == H.fit(learn)
    assert H.f1(H.judged(rest, model)) > 0.85
    assert H.fit([]) == H.DEFAULT == H.fit([H.blocks("<p>No mark here.</p>")])


def test_min_cut_is_minimal():
    import itertools
    import random

    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def price(label):
            return sum(-s if s < 0 and x else s if s > 0 and not x else 0 for s, x in zip(scores, label)) + sum(c for a, b, c in edges if label[a] != label[b])

        assert abs(price(H.min_cut(scores, edges)) - min(map(price, itertools.product((0, 1), repeat=n)))) < 1e-9


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 3), (1, "u", PAGE, 3), (2, None, None, 4), (None, "v", "", 5)], "page_id long, url string, html string, text int")
    rows = sorted(H.extract(pages).withColumn("n", F.length("text")).collect(), key=str)
    assert [r.text for r in rows if r.page_id == 1] == [H.main_text(PAGE)] * 2
    assert [r.text for r in rows if r.page_id != 1] == ["", ""]
    assert H.extract(pages.limit(0)).collect() == []
