import numpy as np
import pytest

from tidemark.llm import html_blocks as hb
from tidemark.llm.queries import op10_main_text, table

FOLDER = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">About &amp; more</a></ul></nav><!-- <p>no</p> -->
<article><h1>Head\n line</h1><p><b>First&nbsp;par <i>x</i><br><p>Second &lt;b&gt; caf&eacute;</p>
<ul><li>one<li>two</ul>tail</article><footer>&copy; me</footer></body></html>"""


def test_blocks():
    blocks = hb.blocks_of(PAGE)
    assert [b.text for b in blocks] == [
        "Home", "About & more", "Head line", "First par x", "Second <b> café", "one", "two", "tail", "© me",
    ]
    assert blocks[0].path == ("html", "body", "nav", "ul", "li") and blocks[0].linked == 4
    assert blocks[4].path == ("html", "body", "article", "p") and blocks[5].path[-2:] == ("ul", "li")
    assert hb.structural_labels(blocks).tolist() == [False, False, True, True, True, True, True, True, False]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<script>x", "<!-- x", "</p></div>", "<div hidden>x</div>", "<title>x</title>"])
def test_pages_without_text(page):
    texts = [b.text for b in hb.blocks_of(page)]
    assert texts in ([], ["<"], ["<p"])


def test_marks_and_quotes():
    blocks = hb.blocks_of("<div class='ad Big' id=x title='a > b'>one</div><p>a<br>b <span>c</span>d")
    assert [b.text for b in blocks] == ["one", "a b cd"] and blocks[0].path == ("div", ".ad", ".big", ".x")
    assert hb.OTHER_MARKS.match(".ad") and hb.OTHER_MARKS.match(".site-footer") and not hb.OTHER_MARKS.match(".adapted-story")


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = hb.Labeller(hidden=3, seed=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask = hb.padded([rng.random((4, hb.DIMS)), rng.random((2, hb.DIMS))])
    y = np.array([[1, 0, 1, 1], [0, 1, 0, 0]], float)

    def loss():
        p = model.chances(x, mask)[0]
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    for name, g in model.gradients(x, mask, y).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, step = model.p[name][at], 1e-3
        model.p[name][at] = old + step
        up = loss()
        model.p[name][at] = old - step
        down = loss()
        model.p[name][at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 2e-3 * max(1, abs(g[at]))


def test_padding_does_not_matter():
    rng = np.random.default_rng(0)
    model, pages = hb.Labeller(), [rng.random((n, hb.DIMS)).astype(np.float32) for n in (1, 5, 30, 0)]
    together = model.label(pages)
    assert all((a == model.label([p])[0]).all() for a, p in zip(together, pages, strict=True))


@pytest.fixture(scope="module")
def trained(spark):
    return hb.train(hb.sampled_pages(table(spark, FOLDER, "pages"), "html", 200))


def test_query_against_the_articles(spark):
    """Held against the article element of every page, read by another parser."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.parts, self.now = False, [], []

        def handle_starttag(self, tag, attrs):
            self.inside |= tag == "article"
            if tag in ("p", "h1", "article", "li", "div"):
                self.flush()
            elif tag == "br":
                self.now.append(" ")

        def handle_endtag(self, tag):
            if tag in ("p", "h1", "article", "li", "div"):
                self.flush()
            if tag == "article":
                self.inside = False

        def handle_data(self, data):
            if self.inside:
                self.now.append(data)

        def flush(self):
            if text := " ".join("".join(self.now).split()):
                self.parts.append(text)
            self.now = []

    pages = {r.page_id: r for r in table(spark, FOLDER, "pages").collect()}
    rows = op10_main_text(spark, FOLDER).collect()
    assert len(rows) == len(pages)
    right = 0
    for r in rows:
        reader = Article()
        reader.feed(pages[r.page_id].html)
        right += r.text == "\n".join(reader.parts)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
    assert right >= 0.98 * len(rows)


def test_unseen_layouts(trained):
    words = "long enough sentences of an article that goes on, and on. They tell a story; it has an end."
    page = f"""<body><header class="masthead"><a href=/>Site</a></header><div class="cookie-notice"><p>We use cookies.</p></div>
    <main><div class="entry-content"><h1>A title of it</h1><p>{words}</p><p>{words} More.</p></div></main>
    <aside class="sidebar"><ul><li><a href=/x>Popular</a></li></ul></aside><section class="comments"><p>Nice one!</p></section>
    <form><p>Subscribe now</p></form><footer><p>All rights reserved</p></footer></body>"""
    blocks = hb.blocks_of(page)
    keep = trained.label([hb.vectors(blocks)])[0]
    assert [b.text for b, k in zip(blocks, keep, strict=True) if k] == ["A title of it", words, words + " More."]


def test_odd_rows(spark, trained):
    rows = [(1, None, "u", 1), (2, "", None, 2), (3, "plain text", "u", 3), (None, PAGE, "u", 4), (4, PAGE, "u", 5), (4, PAGE, "u", 5)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, text long")
    found = hb.extract(pages, model=trained).collect()
    assert len(found) == 6 and [r.text for r in found if r.page_id in (1, 2)] == ["", ""]
    assert len({r.text for r in found if r.page_id == 4}) == 1
    assert hb.extract(pages.where("page_id = 1"), sample_pages=5).first().text == ""
    assert hb.extract(pages.where("page_id < 0"), sample_pages=5).count() == 0


@pytest.mark.parametrize("part", ["<div>x", '<a "', "<p><td><ul>x", "<script ", "<!", "<b>x", "<p><b>", "<!--", "<a '\"", "<li><a href=x>y"])
def test_hostile_pages_are_read_in_linear_time(part):
    """Deep nesting, unclosed quotes, tags and comments: ten times the page takes about ten times as long."""
    import time

    def seconds(n):
        began = time.perf_counter()
        hb.vectors(hb.blocks_of(part * n))
        return time.perf_counter() - began

    few = max(seconds(3_000), 0.02)
    assert seconds(30_000) < 40 * few


def test_unclosed_quotes_do_not_swallow_what_follows():
    page = "<p a=\"x>one</p><p>two</p><b 'y>z</b>"
    assert "".join(b.text for b in hb.blocks_of(page)) == '<p a="x>onetwo<b \'y>z'
    assert [b.text for b in hb.blocks_of("<p x=\"a>b\" y='c\">d'>one</p><p q=\"r>two")] == ["one", '<p q="r>two']


def test_deep_paths_keep_their_features():
    blocks = hb.blocks_of("<div class=ad>" * 300 + "x" + "</div>" * 300 + "<p>y")
    assert len(blocks[0].path) == 600 and blocks[1].path == ("p",)
    assert (blocks[1].tags == hb.Block.of(("p",), "y", 0).tags).all()
    assert (blocks[0].tags == hb.Block.of(blocks[0].path, "x", 0).tags).all()


STORY = "The town on the hill, which few had seen, kept its {} gates open all through the long winter of that year."


def div_page(k):
    text = "".join(f"<div class=t>{STORY.format(w)}</div>" for w in ("old", "iron", f"{k}th"))
    menu = "".join(f"<div class=m><a href=/{i}>Item {i}</a></div>" for i in range(4))
    return f"<body><div class=menu>{menu}</div><div class=b>{text}</div><div class=footer>Owner {k}</div></body>"


def test_tables_without_articles_are_learned_by_density(spark):
    pages = spark.createDataFrame([(k, div_page(k), "u") for k in range(60)], "page_id long, html string, url string")
    found = hb.extract(pages).collect()
    assert all(r.text.split("\n") == [STORY.format(w) for w in ("old", "iron", f"{r.page_id}th")] for r in found)


def test_nothing_to_learn_from_gives_a_trained_labeller():
    model, start = hb.train([]), hb.Labeller(seed=7)
    assert not np.allclose(model.p["o"], start.p["o"])
    blocks = hb.blocks_of("<body><nav><a href=/>Home</a></nav><article><p>" + STORY + "</p></article><footer>All rights</footer>")
    assert model.label([hb.vectors(blocks)])[0].tolist() == [False, True, False]


def test_articles_are_found_among_many_pages_without_any(spark):
    rows = [(k, div_page(k)) for k in range(300)] + [(900, PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, html string").repartition(3)
    assert hb.sampled_pages(pages, "html", 20) == [PAGE]


@pytest.mark.parametrize("wrapper, part", [("<div class=story>", "<div class=promo-box>"), ("<section class=entry-content>", "<aside>")])
def test_layouts_held_out(trained, wrapper, part):
    """The texts stand in layouts that no page of the table has."""
    right = wrong = 0
    for k in range(40):
        body = [STORY.format(f"{w} {k}") for w in ("old", "new", "high")]
        page = f"<body><header><a href=/>Site {k}</a></header>{part}<p>Buy {k} now</p></aside></div>{wrapper}" + "".join(f"<p>{b}</p>" for b in body)
        blocks = hb.blocks_of(page + "</div></section><footer>Imprint</footer>")
        keep = trained.label([hb.vectors(blocks)])[0]
        for b, said in zip(blocks, keep, strict=True):
            right, wrong = right + (said == (b.text in body)), wrong + (said != (b.text in body))
    assert right >= 0.95 * (right + wrong)


def test_long_pages_are_learned_whole():
    page = "<article>" + "".join(f"<p>{STORY.format(k)}</p>" for k in range(400)) + "</article>"
    data = hb.examples([page], 0, np.random.default_rng(0))
    assert [len(v) for v, _ in data] == [400]
    assert [len(b) for b in hb.batches_of(data * 70, steps=4_000)] == [10] * 7
