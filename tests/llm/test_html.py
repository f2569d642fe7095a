"""Main-text extraction."""

import html
import re

import numpy as np
import pytest

from pulseline.llm import catalog, html_text
from pulseline.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return {r.page_id: r for r in table(spark, SF, "pages").collect()}


@pytest.fixture(scope="module")
def model(pages):
    return html_text.learn([pages[i].html for i in sorted(pages)[:150]])


def article(page):
    inner = page.split("<article>")[1].split("</article>")[0]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_query(spark, pages):
    rows = catalog.op10_main_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_unseen_pages_with_other_containers(pages, model):
    rest = [pages[i].html for i in sorted(pages)[150:]]
    other = [re.sub(r"<(/?)footer>", r"<\1section>", p.replace("<article>", '<div class="post">').replace("</article>", "</div>")
                    .replace("<nav>", '<div id="menu">').replace("</nav>", "</div>")) for p in rest]
    found = html_text.main_texts(model, other)
    assert np.mean([f == article(p) for f, p in zip(found, rest)]) > 0.9


def test_blocks():
    page = ("<!DOCTYPE html><head><title>no</title><style>p{}</style></head><body class='a b'><!-- x <p>no</p> -->"
            "<script>var t='</p>';</script><div id=main>one <b>two</b>&nbsp;three<br>four<p>five &amp;amp; &lt;p&gt;<p>six"
            "<a href='x>y'>seven</a></div><li>eight<li>nine &copy <select><option>no</select>ten<img src=x><p")
    found = html_text.blocks_of(page)
    assert [b.text for b in found] == ["one two three four", "five &amp; <p>", "sixseven", "eight", "nine ©", "ten"]
    assert found[0].path == ("body", "a", "b", "div", "main") and found[2].linked == 5


@pytest.mark.parametrize("start", ["<body>", "<BODY class=x>", "<div>", "<p>", "<b>", "words ", "<body><select><option>a<option>b</select>",
                                   "<body><select><optgroup><option>a<optgroup><option>b<select>", "<body><select><option>a<input>",
                                   "<body><select><option>a<textarea>no</textarea>", "<body><button>a<button>b</button>",
                                   "<body><table><tr><td><select><option>a<td>"])
def test_end_tags_left_out(start):
    """Hidden elements end where HTML ends them, not with the page."""
    page = "<!DOCTYPE html><html><head>\n<meta charset=utf-8><title>no</title><link rel=x><style>p{}</style>\n%s<p>one<p>two</html>"
    assert [b.text for b in html_text.blocks_of(page % start)][-2:] == ["one", "two"]
    whole = html_text.blocks_of(page % ("</head>" + start))
    assert [b.text for b in html_text.blocks_of(page % start)] == [b.text for b in whole] and "head" not in whole[0].path
    assert [b.text for b in html_text.blocks_of("<div>zero</div>" + page % start)] == ["zero"] + [b.text for b in whole]


def test_all_words_of_a_name():
    page = '<div class="flex flex-col items-center justify-between p-4 gap-2 text-sm sidebar">x</div>'
    found = html_text.blocks_of(page)[0]
    assert found.path[-1] == "sidebar" and html_text.declared(found) == 0


def test_end_tags_below_the_deepest_level():
    deep = html_text.DEPTH + 50
    page = "<article>" + "<div>" * deep + "one<button>no<button>no</button>two" + "</div>" * deep + "<p>three</article><p>four"
    found = html_text.blocks_of(page)
    assert [(b.text, html_text.declared(b)) for b in found] == [("one", 1), ("two", 1), ("three", 1), ("four", None)]
    assert found[2].path == ("article", "p")


def test_all_blocks_of_a_sampled_page(monkeypatch):
    page = "<article>" + "<p>words of the story" * 450 + "</article><footer>" + "<p>legal notice" * 30 + "</footer>"
    seen, real = [], html_text._gradients
    monkeypatch.setattr(html_text, "_gradients", lambda w, pages, labels, total: (
        seen.append((len(pages), [len(p) for p in pages], [int(y.sum()) for y in labels], total)), real(w, pages, labels, total))[1])
    html_text.learn([page] * 40, epochs=1)
    assert sum(n for n, *_ in seen) == 40 and {(s, y) for _, ss, ys, _ in seen for s, y in zip(ss, ys)} == {(480, 450)}
    assert [t for *_, t in seen] == [20 * 480] * 2
    seen.clear()
    monkeypatch.setattr(html_text, "TRAIN_CELLS", 1000)
    html_text.learn([page] * 40, epochs=1)
    assert [n for n, *_ in seen] == [2] * 20 and {t for *_, t in seen} == {20 * 480}


def test_text_of_page_without_head_end(pages, model):
    given = [pages[i].html for i in sorted(pages)[150:]]
    assert all("</head>" in p for p in given)
    assert html_text.main_texts(model, [p.replace("</head>", "") for p in given]) == html_text.main_texts(model, given)


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "<script>", "&", "<p></p>", "</div></p>", "<div " * 500, "<a href='" * 300,
                                  "<div>" * 3000 + "x", "text only &am", "<p>" + "word " * 200_000])
def test_odd_pages(model, page):
    text = html_text.main_texts(model, [page])[0]
    assert isinstance(text, str) and "<div" not in text


def test_nulls_copies_and_empty_tables(spark, model, pages):
    one = pages[0].html
    df = spark.createDataFrame([(1, None, 0), (1, one, 0), (None, one, 0), (3, "", 0)], "page_id long, html string, n_chars int")
    rows = df.select("page_id", html_text.main_text(df.html, model).alias("t")).collect()
    assert sorted(r.t for r in rows) == ["", "", article(one), article(one)]
    assert html_text.fit(df.limit(0)).weights == {}
    assert html_text.main_texts(html_text.Model({}), ["<p>a</p><p>b</p>"]) == ["a\n\nb"]


def test_gradients():
    """Backpropagation agrees with finite differences."""
    rng = np.random.default_rng(1)
    pre, u = rng.normal(size=(4, 3, 8)), rng.normal(size=(2, 8)) * 0.5
    goal = rng.normal(size=(4, 3, 2))
    loss = lambda p, v: (html_text._lstm(p, v)[0][1:] * goal).sum()
    dp, du = html_text._lstm_back(goal, u, *html_text._lstm(pre, u))
    for array, grad in ((pre, dp), (u, du)):
        for at in [tuple(rng.integers(0, s) for s in array.shape) for _ in range(12)]:
            keep, eps = array[at], 1e-5
            array[at] = keep + eps
            up = loss(pre, u)
            array[at] = keep - eps
            down = loss(pre, u)
            array[at] = keep
            assert abs((up - down) / (2 * eps) - grad[at]) < 1e-6
