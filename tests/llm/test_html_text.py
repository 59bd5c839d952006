"""Main text: minimum cut against all labellings, pages of several layouts, edge cases."""

import html
import random
import re
from itertools import product

import pytest

from streambed.llm import html_text as h
from streambed.llm.queries import op2_html_text
from tests.llm.fixtures import TINY


def test_cut_is_the_smallest_of_all_labellings():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 8)
        source, sink = [rng.randint(0, 9) for _ in range(n)], [rng.randint(0, 9) for _ in range(n)]
        ties = {(a, b): rng.randint(0, 7) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5}

        def cost(side):
            own = sum(t if kept else s for kept, s, t in zip(side, source, sink))
            return own + sum(c for (a, b), c in ties.items() if side[a] != side[b])

        best = min(cost(side) for side in product([False, True], repeat=n))
        assert cost(h.min_cut(source, sink, ties)) == best


TEXT = "This is a sentence of the story, with enough words in it to be told from a label. "
NAV = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></nav>"
FOOT = "<footer>&copy; 2024 Example. All rights reserved.</footer>"
PAGES = {
    "article": f"<html><head><title>T</title></head><body>{NAV}<article><h1>Head</h1><p>{TEXT}<p>{TEXT}</article>{FOOT}",
    "plain divs": f"<body><div class='menu'><a href=x>One</a> <a href=y>Two</a></div><div id=content><h1>Head</h1><div>{TEXT}</div><div>{TEXT}</div></div><div class='footer'>Imprint</div>",
    "header in article": f"<article><header><h1>Head</h1></header><p>{TEXT}</p><p>{TEXT}</p></article>",
    "site header": f"<header><a href=/>Site</a><p>Our site has a long slogan that says many words.</p></header><main><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></main>",
    "comments": f"<article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p><section class=comments><article class=comment><p>{TEXT}Nice!</p></article></section></article>",
    "comments after": f"<article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></article><div id='comments'><ol><li>{TEXT}I agree.</ol></div>",
    "sidebar": f"<div><article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></article><aside><p>{TEXT}</p></aside><div class=sidebar><p>{TEXT}</p></div></div>",
    "advert inside": f"<article><h1>Head</h1><p>{TEXT}</p><div class='ad'>{TEXT}</div><p>{TEXT}</p></article>",
    "form": f"<article><h1>Head</h1><p>{TEXT}</p><form><p>{TEXT}</p><input><button>Send</button><select><option>A</select></form><p>{TEXT}</p></article>",
    "notice": f"<div class='cookie-notice'>{TEXT}</div><article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></article>",
    "scripts": f"<script>var a='</p>{TEXT}';</script><style>p{{}}</style><article><h1>Head</h1><p>{TEXT}<!-- {TEXT} --></p><script>x</script><p>{TEXT}</p></article><noscript>{TEXT}</noscript>",
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    assert h.main_text(PAGES[name]) == " ".join(["Head", TEXT.strip(), TEXT.strip()])


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<", ""), ("<nav>only</nav>", ""), ("<script>never closed", ""),
        ("<!-- never closed <p>x", ""),
        (f"<article><p>AT&amp<b>;</b> and &l<i></i>t; {TEXT}</p></article>", f"AT&; and &lt; {TEXT.strip()}"),
        (f"<article><p>a &lt;b&gt; &amp; c&nbsp;d &#233;&eacute; 1 < 2 {TEXT}</p></article>", f"a <b> & c d éé 1 < 2 {TEXT.strip()}"),
        (f"<article><p>on<b>e</b> <i>two</i>\n\t three<br>four {TEXT}</article>", f"one two three four {TEXT.strip()}"),
        (f"<ARTICLE><P CLASS='x>y'>{TEXT}</P></ARTICLE>", TEXT.strip()),
    ],
)
def test_odd_pages(page, text):
    assert h.main_text(page) == text


@pytest.mark.parametrize("tag", ["noscript", "template", "svg", "object", "select", "video", "audio", "math", "canvas", "datalist"])
def test_unclosed_silent_elements_keep_what_follows(tag):
    article = f"<article><p>{TEXT}</p></article>"
    assert h.main_text(f"<{tag}>{article}") == TEXT.strip()
    assert h.main_text(f"<{tag}>x y</{tag}><{tag} title='a>b'>{TEXT}</{tag}><{tag}>{article}") == TEXT.strip()
    assert h.main_text(f"<{tag} class='a>b'><{tag}>{TEXT}</{tag}>{TEXT}</{tag}>{article}") == TEXT.strip()


@pytest.mark.parametrize("head", [
    "<head>", "<html><head><title>T</title>", "<head><meta charset=a><!-- <p>c --><script>'<div>'</script><STYLE>p{}</STYLE>",
    "<head><noscript><img src=a></noscript><link rel=b>", "<head><title>T</title></html>", "<head><base/><template><p>x</template>",
])
def test_heads_without_end_tag(head):
    article = f"<article><h1>Head</h1><p>{TEXT}</p></article>"
    assert h.main_text(head + article) == "Head " + TEXT.strip()
    assert h.main_text(f"{head}\n<body class=c>{article}") == "Head " + TEXT.strip()
    assert h.main_text(head + TEXT * 3) == (TEXT * 3).strip()


def test_many_unclosed_elements_take_no_longer_each():
    assert h.main_text("<article>" + "<svg><select>" * 30000 + f"<p>{TEXT}</p></article>") == TEXT.strip()


def test_long_and_deep_pages():
    assert h.main_text("<article>" + f"<p>{TEXT}</p>" * 3000 + "</article>") == " ".join([TEXT.strip()] * 3000)
    assert h.main_text("<article>" + "<div>" * 5000 + TEXT * 2) == (TEXT * 2).strip()


def test_query_gives_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{TINY}/pages.parquet").collect()}
    found = op2_html_text(spark, TINY).collect()
    assert len(found) == len(pages)
    for r in found:
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.DOTALL)[1]
        inner = re.sub(r"</?[a-zA-Z][^>]*>", "", re.sub(r"</?(p|h1|br|ul|li|div)\b[^>]*>", " ", inner))
        assert r.text == " ".join(html.unescape(inner).split()) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    rows = [(1, "u", PAGES["article"], "x"), (1, "u", PAGES["article"], "y"), (None, None, None, None), (2, "v", "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    want = " ".join(["Head", TEXT.strip(), TEXT.strip()])
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in h.extract(pages).collect()]
    assert sorted(got, key=repr) == sorted([(1, "u", want, len(want))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert h.extract(pages.limit(0)).count() == 0
