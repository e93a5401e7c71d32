"""Main texts of written pages."""

import pytest

from addrspark.llm.html_text import extracted, lines_of, main_lines, main_text

ARTICLE = "<article><h1>A &amp; B</h1><p>First <b>bold</b>  text\n with lines.</p><p>Of.</p><p>Last one&nbsp;here.</article>"


@pytest.mark.parametrize("html", [
    f"<html><head><title>T</title><style>p{{x}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>"
    f"<!-- ad --><div class='ad'>Buy this now. Please do buy it.</div>{ARTICLE}<footer>&copy; someone</footer></body></html>",
    f"<header><h1>Site</h1></header><aside>Side text that is rather long, too long.</aside>{ARTICLE}<section id=comments><p>I disagree.</p></section>",
    f"<form><p>Name</p><input name=x></form><div class='cookie-notice'>We use cookies</div>{ARTICLE}<div class=sidebarLeft>x</div>",
    f"{ARTICLE}<div role='navigation'>a b c</div><p hidden>no</p><noscript>Turn it on</noscript>",
    ARTICLE.replace("<article>", "<main>").replace("</article>", "</p><div class='ad'><p>In between</p></div></main>"),
])
def test_article_without_the_rest(html):
    assert main_text(html) == "A & B\nFirst bold text with lines.\nOf.\nLast one here."


def test_without_article_markup():
    body = "".join(f"<p>Paragraph number {i} with quite some words in it.</p>" for i in range(6))
    page = f"<div><a href=1>Home</a> <a href=2>News</a></div><div>x</div>{body}<div><a href=3>Imprint</a></div>"
    assert main_text(page) == "x\n" + "\n".join(f"Paragraph number {i} with quite some words in it." for i in range(6))


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &lt;text&gt; only", "plain <text> only"), ("<nav>menu</nav>", ""), ("<p>a<br>b</p>", "a b"),
    ("<article><p>one<p>two<div>three</div>four</article>", "one\ntwo\nthree\nfour"), ("<script>never closed", ""), ("<article>a<!-- never closed", "a"),
    ("<article><p>x &am</p><p>&amp</p><p>&#233;&eacute;</p></article>", "x &am\n&\néé"), ("a < b and <article", "a < b and"),
    ("<article><p><b>open<br><p>next</p></article><footer>f</footer>", "open\nnext"),
])
def test_small_pages(html, text):
    assert main_text(html) == text


def test_table(spark):
    rows = [(1, "u", f"<article><p>{'long ' * 50000}</p></article>", "t", 1), (2, None, None, "t", 2), (None, "u", "<p>x", None, None), (None, "u", "<p>x", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extracted(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, ((r.page_id, r.url, r.n_chars, r.text[:6]) for r in got.collect()))) == sorted(map(str, [
        (1, "u", 249999, "long l"), (2, None, 0, ""), (None, "u", 1, "x"), (None, "u", 1, "x")]))
    assert extracted(pages.limit(0)).count() == 0


PARAGRAPHS = [f"Paragraph number {i} with quite some words in it." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
TEXT = "\n".join(PARAGRAPHS)
LINKS = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>"
AD = "<div class=ad><p>Buy</p><p>this</p><p>now</p><p>please</p></div>"


@pytest.mark.parametrize("name", ["layout with-sidebar", "no-sidebar", "page sidebar-right", "cols hasSidebar"])
def test_names_of_the_layout_do_not_lose_the_article(name):
    side = "<div class=sidebar><p>Beside the text.</p></div>"
    assert main_text(f"<div class='{name}'><nav>menu</nav>{side}<article>{BODY}</article></div><footer>f</footer>") == TEXT
    assert main_text(f"<p>Top.</p><div class='{name}'>{side}{BODY}</div><footer>f</footer>") == "Top.\n" + TEXT
    assert main_text(f"<main class='{name}'>{side}{BODY}</main><section id=comments>{BODY}{BODY}</section>") == TEXT


def test_header_of_the_text_stays():
    assert main_text(f"<div class='post-header'><h1>Title</h1></div>{BODY}") == "Title\n" + TEXT
    assert main_text(f"<article><div class=header><h1>Title</h1></div>{BODY}</article>") == "Title\n" + TEXT
    assert main_text(f"<div class=site-header><p>Site</p></div>{BODY}") == TEXT


def test_boilerplate_that_is_long_stays_out():
    long = "<p>" + "We use cookies for many things. " * 9 + "</p>"
    assert main_text(f"<div class='cookie-notice'>{long}</div><article>{BODY}</article>") == TEXT
    assert main_text(f"<div class='cookie-notice'>{long}</div>{BODY}") == TEXT
    assert main_text(f"<div>{BODY}</div><div class=comments>{BODY}{BODY}{BODY}</div>") == TEXT


@pytest.mark.parametrize("card", [
    "<article class='comment'><p>I disagree with all that.</p></article>", "<article><h3><a href=x>Next story</a></h3><p>Teaser of it.</p></article>",
    "<article class='comment'>" + BODY + "</article>", "<article hidden>" + BODY + "</article>"])
def test_the_heaviest_stretch_tells_whether_articles_hold_the_text(card):
    assert main_text(f"<div class='post'>{BODY}</div>{card}") == TEXT
    assert main_text(f"{card}<div class='post'>{BODY}</div>{LINKS}") == TEXT
    assert main_text(f"<article>{BODY}</article>{card}").startswith(TEXT)


def test_lists_of_named_articles_stay():
    cards = "".join(f"<article class='card promo tag-news category-newsletter'><p>{p}</p></article>" for p in PARAGRAPHS)
    assert main_text(f"<nav>menu</nav><main>{cards}</main>") == main_text(f"<nav>menu</nav>{cards}") == TEXT


def test_articles_of_half_the_text_are_no_cards():
    assert main_text(f"<div>{BODY}</div><article>{PARAGRAPHS[0]}{PARAGRAPHS[1]}</article>").startswith(TEXT + "\nParagraph number 0")
    assert main_text(f"<article>{BODY}</article><div><p>Imprint of the site.</p></div>") == TEXT


def test_gaps_are_bridged():
    assert main_text(f"<h1>Title</h1>{AD}{BODY}{AD}<p>The end.</p>") == f"Title\n{TEXT}\nThe end."
    assert main_text(f"<div><h1>Title</h1></div>{LINKS}{BODY}") == "Title\n" + TEXT
    assert main_text(f"<article><p>First.</p>{LINKS}{BODY}{AD}<p>Of.</p></article>") == f"First.\nOne\nTwo\nThree\n{TEXT}\nOf."


def test_windows_decide():
    lines = lines_of(f"<p>Short.</p>{LINKS}{BODY}{LINKS}<p>Imprint.</p>")
    assert main_lines(lines) == PARAGRAPHS
    assert main_lines(lines, window=5) == main_lines(lines, surge=0.01) == ["Short.", *PARAGRAPHS, "Imprint."]
    # An article of a quarter of the text is a stretch as others are: its one window is two thirds of the largest.
    lines = lines_of(f"<article>{PARAGRAPHS[0]} {PARAGRAPHS[1]}</article>{LINKS}{BODY}")
    assert main_lines(lines) == [f"{PARAGRAPHS[0]} {PARAGRAPHS[1]}", *PARAGRAPHS]
    assert main_lines(lines, surge=0.8) == PARAGRAPHS


def test_quotes_have_a_meaning_only_at_the_beginning_of_a_value():
    assert main_text("<body><p title=don't>Two.</p><p>Three isn't.</p></body>") == "Two.\nThree isn't."
    assert main_text("<body><p title='a > b' data-x=\"it's\">Two.</p><p don't>Three.</p></body>") == "Two.\nThree."
    assert main_text('<body><p>One.</p><p title="never closed>Two.</p><p>Three.</p></body>') == "One.\nTwo.\nThree."
    assert main_text("<body><p title='class=sidebar id=ad'>Two.</p></body>") == "Two."


def test_lines_between_surge_and_dive_stay():
    text = "This is a paragraph of the text, as long as paragraphs are. " * 3
    page = f"<body><ul><li><a href=x>menu</a><li><a href=y>more</a></ul><p>{text}</p><p><a href=z>All of this line is a link.</a></p><p>{text}</p>" \
        "<ul><li><a href=x>next</a><li><a href=y>previous</a><li><a href=y>up</a></ul></body>"
    assert main_text(page).split("\n") == [text.strip(), "All of this line is a link.", text.strip()]


def test_text_of_buttons_formulas_and_drawings():
    page = "<article><p>Press <button>Start</button> if <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p><svg><title>t</title><text>Axis</text></svg>" \
        "<form><button>Send</button></form></article>"
    assert main_text(page) == "Press Start if x=2.\nAxis"


def plain_stretches(weights, window, surge):
    """Line by line: the lines from a window over the surge level on until a window without text."""
    def size(i):
        return sum(weights[i : i + window])
    level, inside, out = surge * max(map(size, range(len(weights)))), False, []
    for i in range(len(weights)):
        if inside and size(i) == 0:
            inside = False
        if not inside and weights[i] and size(i) > level:
            inside = True
        if inside and (weights[i] or 0 < i < len(weights) - 1 and weights[i - 1] and weights[i + 1]):
            out.append(i)
    return out


@pytest.mark.parametrize("window, surge", [(1, 0.5), (3, 0.1), (3, 0.6), (6, 0.3)])
def test_pages_without_article_markup_by_a_plain_search(window, surge):
    import random

    rng = random.Random(window)
    for _ in range(60):
        kinds = [rng.choice(["text", "short", "link", "link", "link"]) for _ in range(rng.randrange(1, 40))]
        lines = [f"{i} " + ("words of a line " * rng.randrange(2, 9) if k == "text" else "few") for i, k in enumerate(kinds)]
        lines = [" ".join(line.split()) for line in lines]
        page = "<body>" + "".join(f"<div>{'<a href=x>' + t + '</a>' if k == 'link' else t}</div>" for k, t in zip(kinds, lines)) + "</body>"
        weights = [0 if k == "link" else len(t) for k, t in zip(kinds, lines)]
        got = main_lines(lines_of(page), window, surge)
        assert got == ([lines[i] for i in plain_stretches(weights, window, surge)] if any(weights) else [])
