import itertools
import random

import pytest

from agorakit.llm import mincut as M

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body class="has-sidebar"><header><div>Site</div><p>Welcome to the best site ever made for everybody.</p></header>
<div class="cookie-notice"><p>We use cookies to make this site better, please accept them all now.</p></div>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<main><article><header><h1>Big &amp; title</h1></header><p>First   paragraph with <a href=x>link</a> inside it,
long enough.<p>Short.</p><!-- <p>no</p> --><aside><p>Related: read our other article about things and stuff.</p></aside>
<ul><li>item one is here<li>item two</ul><p>Final&nbsp;words&#33; <br>of the <b>article.</article>
<section id="comments"><h2>comments</h2><p>I really liked this article a lot, thank you for writing it up.</p></section></main>
<div id="sidebar"><p>Some words of the side bar that nobody ever reads at all.</p></div>
<form><label>Email</label><p>Please give us your address so we can write to you daily.</p></form>
<footer>&copy; 2020 somebody</footer></body></html>"""


def test_article_alone_is_kept():
    assert M.content(PAGE)[0] == (
        "Big & title First paragraph with link inside it, long enough. Short. item one is here item two Final words! of the article."
    )


def test_short_paragraphs_follow_their_neighbours():
    long = "One paragraph that has many words in it and ends as it should."
    page = f"<div><p>{long}</p><p>Yes.</p><p>{long}</p></div><div class=ad>Buy now</div>"
    assert M.content(page)[0] == f"{long} Yes. {long}"


@pytest.mark.parametrize("page", [None, "", "<p", "<", "<<p>>", "</", "<!--", "&", "<script>x", "<p a=\"x", "<table><tr><td>" * 50, "\x00", "<a href='>x</a>"])
def test_broken_pages_do_not_fail(page):
    text, n, kept = M.content(page)
    assert isinstance(text, str) and 0 <= kept <= n


def test_truncated_page_is_read_as_far_as_it_goes():
    cut = PAGE[: PAGE.index("item two")]
    assert M.content(cut)[0].endswith("Short. item one is here")


def test_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 8)
        gain = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(label):
            return -sum(g for g, x in zip(gain, label) if x) + sum(w for a, b, w in edges if label[a] != label[b])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(M.minimum_cut(gain, edges)) - best) < 1e-9


def test_rows_of_a_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = M.main_text(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in found) == sorted([("1", len(M.content(PAGE)[0]))] * 2 + [("2", 0), ("None", 0)])
    assert M.main_text(pages.limit(0)).count() == 0


def test_very_long_page_is_whole():
    body = "".join(f"<p>Paragraph number {i} says what it has to say.</p>" for i in range(3000))
    assert M.content(f"<article>{body}</article>")[2] == 3000


@pytest.mark.parametrize("page, text", [
    ("<p>One two three four five, six.</p><video src=a><p>Next paragraph of words that are many.</p>", "One two three four five, six. Next paragraph of words that are many."),
    ("<article><p>Before it there were some words.</p><svg><text>no</text></svg><p>After it there were some words.</p></article>", "Before it there were some words. After it there were some words."),
    ("<article><p>We know that <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for all.</p></article>", "We know that x=2 holds for all."),
    ("<div class='post-content related-work'><h1>Of the sea</h1><p>A paragraph that says, at some length, what it has to say.</p><p>Yes.</p></div>", "Of the sea A paragraph that says, at some length, what it has to say. Yes."),
])
def test_no_text_is_swallowed(page, text):
    assert M.content(page)[0] == text


def _varied(seed):
    """(html, the texts that are content) of a page: layouts without article or with ordinary class words, unclosed tags, deep divs."""
    rng = random.Random(seed)
    words = "water stone morning river people carry small house under winter light every garden letter follow between market summer".split()
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    sentence = lambda n: some(n // 2) + ", " + some(n - n // 2) + "."
    end = rng.choice(["</p>", "</p>", ""])
    title, kept = some(rng.randint(1, 4)).capitalize(), []  # content begins with a capital letter, other texts do not
    body = f"<h1>{title}</h1>"
    kept.append(title)
    for i in range(rng.randint(3, 7)):
        kind = rng.choice("ppppslq")
        texts = {"s": [some(1) + "."], "l": [some(2), some(1), some(3)], "q": [sentence(14)]}.get(kind, [sentence(rng.randint(10, 40))])
        texts = [t.capitalize() for t in texts]
        kept += texts
        if kind == "l":
            body += f"<ul>{''.join('<li>' + t for t in texts)}</ul>"
        else:
            body += f"<blockquote>{texts[0]}</blockquote>" if kind == "q" else f"<p>{texts[0]}{end}"
    wrap = rng.choice(["<div>{}</div>", "<div class='col-9'><div><div>{}</div></div></div>", "<div class='share-text content'>{}</div>", "<article>{}</article>", "<table><tr><td>{}</td></tr></table>", "<div class=tags>{}</div>"])
    links = "".join(f"<li><a href=/{i}>{some(rng.randint(1, 3))}</a>" for i in range(rng.randint(3, 8)))
    top = rng.choice(["<nav><ul>{}</ul></nav>", "<div><ul>{}</ul></div>", "<ul>{}</ul>"]).format(links)
    advert = rng.choice([f"<div class=ad><p>{sentence(12)}</p></div>", f"<div class='cookie-bar'>{sentence(9)}</div>", ""])
    talk = rng.choice([f"<section id=comments><h2>comments</h2><p>{sentence(20)}</p><p>{sentence(8)}</p></section>", ""])
    side = rng.choice([f"<aside><h3>{some(2)}</h3><p>{sentence(10)}</p></aside>", f"<div class=sidebar><ul>{links}</ul><p>{sentence(7)}</p></div>", ""])
    foot = rng.choice([f"<footer><p>{sentence(8)}</p></footer>", f"<div><a href=/a>{some(2)}</a> | <a href=/b>{some(1)}</a></div>"])
    return f"<html><body>{top}{advert}{wrap.format(body)}{talk}{side}{foot}</body></html>", kept


def test_the_cut_decides_on_varied_pages():
    right = blocks = flow = whole = 0
    for seed in range(120):
        page, kept = _varied(seed)
        found = M.blocks(page)
        keep, gain = M.labels(found)
        whole += [b.text for b, k in zip(found, keep) if k] == kept
        for b, k, g in zip(found, keep, gain):
            blocks += 1
            right += b.text[0].isupper() == k
            flow += k != (g > 0)
    assert right >= 0.96 * blocks and flow >= 0.05 * blocks and whole >= 0.9 * 120, (right, flow, blocks, whole)


def test_deep_markup_takes_linear_time():
    import time

    for page in ("<span>" * 50_000 + "<p>a" * 50_000, "<div>" * 50_000 + "</section>" * 50_000, "<ul><li>x<div>" * 30_000, "<video>x<p>" * 30_000):
        at = time.process_time()
        M.content(page)
        assert time.process_time() - at < 10
