import itertools
import math
import random
import time

from lumenframe.llm import html_extract as m
from lumenframe.llm.html_pages import PARAGRAPHS, _links, _Page, _sentence, labelled_page
from lumenframe.llm.html_tree import parse


def truth(page):
    tree = parse(page)
    state, blocks, current = m.page_labels(tree), [], []
    for e, piece, fresh in tree.text:
        if fresh and current:
            blocks.append("".join(current))
            current = []
        if state[e] and tree.tag[e] not in m.HIDDEN:
            current.append(piece)
    blocks.append("".join(current))
    return " ".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def test_marginals_against_enumeration():
    r = random.Random(1)
    model = m.TreeModel([r.uniform(-2, 2) for _ in range(m.N_FEATURES)], [[[r.uniform(-1, 1) for _ in range(2)] for _ in range(2)] for _ in m.KINDS], 0.3)
    tree = parse("<div><p>a<b>b</b></p><ul><li>c<li>d</ul></div><p>e")
    n, features = len(tree.tag), m.node_features(tree)
    total, on = 0.0, [0.0] * n
    for states in itertools.product((0, 1), repeat=n):
        z = sum(sum(model.weights[f] for f in features[i]) for i in range(n) if states[i]) + 0.3 * states[0]
        z += sum(model.edges[m._kind(tree.tag[i])][states[tree.parent[i]]][states[i]] for i in range(1, n))
        total += math.exp(z)
        for i in range(n):
            on[i] += math.exp(z) * states[i]
    for a, b in zip(model.marginals(tree), on):
        assert abs(a - b / total) < 1e-9


def test_held_out_labelled_pages():
    model = m.default_model()
    pages = [labelled_page(10**6 + i) for i in range(200)]
    assert sum(m.main_text(p, model) == truth(p) for p in pages) >= 180


def word_accuracy(pages):
    """Share of the words, of those that are shown, that are rightly kept or left out."""
    right = total = 0
    for page in pages:
        tree = parse(page)
        kept, state = m.default_model().marginals(tree), m.page_labels(tree)
        for e, piece, _ in tree.text:
            if tree.tag[e] not in m.HIDDEN:
                n = len(piece.split())
                total += n
                right += n * ((kept[e] >= 0.5) == (state[e] == 1))
    return right / total


def test_names_that_tell_nothing():
    """Class names made up of random letters: tags, sizes and links alone tell the text apart."""
    assert word_accuracy(labelled_page(2 * 10**6 + i, unnamed=True) for i in range(300)) >= 0.9


def test_many_paragraphs_of_any_length():
    """Neither the number nor the length of the paragraphs makes an article vanish, or its comments appear."""
    r, model = _Page(5), m.default_model()
    for size in PARAGRAPHS:
        for n in (1, 10, 200):
            for begin, end in (("<article>", "</article>"), ('<div class="content">', "</div>")):
                text = [_sentence(r, *size) for _ in range(n)]
                comments = "".join(f"<p>{_sentence(r, *size)}</p>" for _ in range(n))
                page = f"<body><nav><ul>{_links(r, 5)}</ul></nav>{begin}<h1>Some title here</h1>" + "".join(f"<p>{t}</p>" for t in text) + f'{end}<div class="comments">{comments}</div><footer>&copy; me</footer></body>'
                assert m.main_text(page, model) == " ".join(["Some title here", *text])


def test_formulas_and_fallbacks_belong_to_the_article():
    page = "<article><h1>The title of it</h1><p>six <math><mi>x</mi>=2</math> seven and more words of the article</p><noscript>shown without scripts</noscript><svg><text>a label</text></svg></article>"
    got = m.main_text(page, m.default_model())
    assert "six x=2 seven" in got and "shown without scripts" in got and "a label" in got


def test_stray_tags_take_linear_time():
    began = time.perf_counter()
    parse("<div>" + "<i>" * 200_000 + "</b></p>" * 200_000 + "<li>" * 200_000)
    assert time.perf_counter() - began < 30  # minutes where each tag looks through the open elements


def test_page():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <nav><ul><li><a href="/x">Menu</a></li><li><a href="/y">More</a></li></ul></nav><div class="cookie-notice">We use cookies.</div><!-- x -->
    <article><h1>The title</h1><p><b>A &amp; B</b> are&nbsp;here,
      and a long sentence goes on with <a href="#">a link</a> inside of it.<br><p>Tom &lt;3 Ann &#8212; caf&eacute;, they said to all of us.</article>
    <aside><p>Buy now</p></aside><div class="comments"><p>First! I like this.</p></div><footer>&copy; me</footer></body></html>"""
    want = "The title A & B are here, and a long sentence goes on with a link inside of it. Tom <3 Ann — café, they said to all of us."
    assert m.main_text(page, m.default_model()) == want


def test_broken_markup():
    model = m.default_model()
    r = random.Random(4)
    bits = ["<p>", "</p>", "<div class='", '"', "<", ">", "</", "<!--", "-->", "<script>", "</script>", "text ", "&amp", "&#x110000;", "<a href=x>", "<li>", "<table><tr><td>", "</html>", "<![CDATA[", "\0"]
    for _ in range(300):
        m.main_text("".join(r.choice(bits) for _ in range(r.randint(0, 60))), model)
    m.main_text("<div>" * 5000 + "deep", model)
    m.main_text("<a b='" * 3000, model)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>One two three four five six.</p></article>"), (1, "u", None), (None, None, "")], "page_id long, url string, html string").selectExpr("*", "7 as text", "8 as _html")
    got = m.extract_main_text(df)
    assert got.columns == ["page_id", "url", "_html", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in got.collect()) == [("", 0), ("", 0), ("One two three four five six.", 28)]
    assert m.extract_main_text(df.limit(0)).count() == 0


def test_names_with_dots_and_of_any_case(spark):
    df = spark.createDataFrame([(1, "x", "y", "<article><h1>A title</h1><p>One two three four five six.</p></article>")], "page_id long, `a.b` string, Text string, html string")
    got = m.extract_main_text(df)
    assert got.columns == ["page_id", "a.b", "text", "n_chars"]
    assert got.first() == (1, "x", "A title One two three four five six.", 36)


def test_head_without_end_tag():
    model = m.default_model()
    main = "<article><h1>The title</h1><p>A long sentence of the main text goes on and on, they said to all of us.</p></article>"
    for head in ("<head><title>T</title><meta charset=utf-8>", "<head><style>p{}</style><noscript><link href=x></noscript>"):
        whole = m.main_text(f"<html>{head}</head><body>{main}</body></html>", model)
        assert "main text goes on" in whole
        assert m.main_text(f"<html>{head}<body>{main}</body></html>", model) == whole
        assert "main text goes on" in m.main_text(f"<html>{head}{main}</html>", model)
    assert parse("<head><template><div>x</div></template><p>y").parent[4] == 0
