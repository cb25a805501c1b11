"""Main text on pages whose article is known."""

from tidemark.llm import html_text as H

WORDS = "Many words make a paragraph that is long enough to be told from a menu, and it goes on for a while. "
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="masthead"><a href="/">Site</a> Slogan of the site, rather long, for what it is worth</header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies, and we tell you so in many words that are no article at all.</div>
<div class="ad">Buy this now, it is the best thing that you can buy today.</div>
{open}<h1>Head &amp; line</h1><p>{w}<p><b>Bold   text<br>next&nbsp;line</b> tail</p><ul><li>first</li><li>second</li></ul>
<p>Short.</p>{close}
<aside>Related stories that nobody asked for but that are long enough to count.</aside>
<form><input name="q"><button>Go</button> Sign up for our letter</form>
<section id="comments"><p>I read it all and I have to say a great deal about it in my comment here.</p></section>
<footer>&copy; 2024 all rights reserved</footer></body></html>"""
WANT = "\n\n".join(["Head & line", WORDS.strip(), "Bold text next line tail", "first", "second", "Short."])


def test_article_element():
    assert H.main_text(PAGE.format(open="<article>", close="</article>", w=WORDS)) == WANT


def test_without_article_element():
    assert H.main_text(PAGE.format(open='<div class="body-text">', close="</div>", w=WORDS * 3)) == WANT.replace(WORDS.strip(), (WORDS * 3).strip())


def test_odd_pages():
    assert H.main_text("") == "" and H.main_text("<nav>only a menu</nav>") == ""
    assert H.main_text("plain text") == "plain text"
    assert H.main_text("<p>a<p>b") == "a\n\nb"
    assert H.main_text("<article><p>cut off <b>in the mid") == "cut off in the mid"
    assert H.main_text("<article><!-- c --><p>x &lt;b&gt; &#233;</p></article>") == "x <b> é"
    deep = "<div>" * 3_000 + "deep" + "</div>" * 3_000
    assert H.main_text(deep) == "deep"
    long = "word " * 200_000
    assert H.main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_header_inside_the_article_stays():
    assert H.main_text("<article><header><h1>Title</h1></header><p>" + WORDS + "</p></article>") == "Title\n\n" + WORDS.strip()


def test_head_without_end_tag():
    text = WORDS.strip()
    for start in ("<body>", "<p>", "<div><p>", "<img src=x>", ""):
        assert H.main_text(f"<html><head><meta charset=utf-8><title>T</title><script>var a;</script>\n{start}{WORDS}") == text
    assert H.main_text(f"<head><noscript><img src=x>unseen</noscript><style>p</style><body><p>{WORDS}</p></body>") == text


def test_article_cards_beside_the_text():
    body = "".join(f"<p>{i} {WORDS * 2}</p>" for i in range(6))
    want = "\n\n".join(f"{i} {(WORDS * 2).strip()}" for i in range(6))
    cards = "".join(f"<article><h3>Card {i}</h3><p>Read this one too, it is of some length at least.</p></article>" for i in range(3))
    for page in ("<body><div>{}</div><section>{}</section></body>", "<body><main><div>{}</div><section>{}</section></main></body>"):
        got = H.main_text(page.format(body, cards))
        assert got.startswith(want)


def test_short_articles_with_chosen_lines_are_kept():
    post = lambda n, k: f"<article><h2>Post {n}</h2><p>{WORDS * k}</p></article>"
    got = H.main_text(f"<body>{post(1, 9)}{post(2, 4)}</body>")
    assert got == "\n\n".join(x for n, k in ((1, 9), (2, 4)) for x in (f"Post {n}", (WORDS * k).strip()))


def test_smoothing_and_threshold():
    import numpy as np

    flat = H.smoothed(np.full(9, 4.0))
    assert np.allclose(flat, 4.0)
    border = H.threshold(np.array([1.0, 2.0, 1.0, 90.0, 110.0, 100.0]))
    assert 2.0 < border < 90.0


def test_frames(spark):
    rows = [(1, "u", PAGE.format(open="<article>", close="</article>", w=WORDS)), (2, None, None), (3, "v", ""), (None, "w", "<p>x</p>"), (3, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r["page_id"] or 0, r["url"] or "", r["text"], r["n_chars"]) for r in H.pages_report(pages).collect()))
    assert got == sorted([(1, "u", WANT, len(WANT)), (2, "", "", 0), (3, "v", "", 0), (3, "v", "", 0), (0, "w", "x", 1)])
    clash = pages.selectExpr("*", "'old' AS text", "'x' AS n_chars", "array(1) AS more")
    assert H.extract(clash).columns == ["page_id", "url", "more", "text", "n_chars"]
    assert H.extract(pages.limit(0)).count() == 0


def test_driver_pages(spark):
    import html
    import re

    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)\b[^>]*>", article)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in blocks]
        assert H.main_text(r["html"]) == "\n\n".join(b for b in blocks if b)


def _prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(n)) + "."


def _page(rnd, outer):
    """A page without article or main, and its text: paragraphs in a plain
    element among link lists, teasers, notices and comments."""
    text = [_prose(rnd, 3), *(_prose(rnd, rnd.randrange(25, 60)) for _ in range(rnd.randrange(3, 9)))]
    links = "".join(f"<li><a href='/{i}'>{_prose(rnd, 2)}</a></li>" for i in range(8))
    links += "".join(f"<li><i>{_prose(rnd, 3)}</i></li>" for _ in range(30))  # as much text as some paragraphs, thinly
    teasers = "".join(f"<div><a href='/t{i}'><b>{_prose(rnd, 3)}</b></a><span>{_prose(rnd, 2)}</span></div>" for i in range(5))
    comments = "".join(f"<div><b>{_prose(rnd, 1)}</b><p>{_prose(rnd, rnd.randrange(5, 20))}</p></div>" for _ in range(4))
    body = f"<h2>{text[0]}</h2>" + "".join(f"<p>{t}</p>" for t in text[1:])
    html = (f"<html><head><title>x</title></head><body><ul>{links}</ul><div class='{outer}'>{body}"
            f"<div class='comments'>{comments}</div></div><div>{teasers}</div><div><ul>{links}</ul></div></body></html>")
    return html, "\n\n".join(text)


PLAIN, NAMED = ["", "x1", "post"], ["content-related", "main-search", "promo"]


def test_regions_are_chosen_by_the_ratios():
    """Pages without article or main: the text and nothing else."""
    import random

    rnd = random.Random(0)
    for i in range(60):
        html, text = _page(rnd, PLAIN[i % len(PLAIN)])
        assert H.main_text(html) == text


def test_no_name_around_the_text_loses_it():
    import random

    rnd = random.Random(1)
    for i in range(60):
        html, text = _page(rnd, NAMED[i % len(NAMED)])
        assert text in H.main_text(html)


def test_without_the_threshold_other_regions_come_out(monkeypatch):
    """The method decides: if every line votes, results change."""
    import random

    rnd = random.Random(0)
    pages = [_page(rnd, PLAIN[i % len(PLAIN)]) for i in range(60)]
    monkeypatch.setattr(H, "threshold", lambda values: 0.0)
    assert sum(H.main_text(html) != text for html, text in pages) > 20


def test_names_do_not_lose_whole_texts():
    long = "A long paragraph of text. " * 20
    for html in (f"<body><div id='main-search'><p>{long}</p></div></body>",
                 f"<body><div class='content-related'><p>{long}</p></div><div><a href='x'>teaser</a> words</div></body>",
                 f"<main><div class='widget'><p>{long}</p><p>{long}</p></div></main>"):
        assert long.strip() in H.main_text(html)
