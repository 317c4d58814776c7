"""Main text: everyday markup around it, and broken pages in linear time."""

import time

import pytest

from skyledger.llm.html_text import main_text

LINES = [f"Paragraph {i} of the text, which goes on for a while and then some more." for i in range(6)]
TEXT = "".join(f"<p>{x}</p>" for x in LINES)
WANT = "\n".join(LINES)


@pytest.mark.parametrize(
    "around",
    [
        '<div style="overflow:hidden">{}</div>',
        '<div data-hidden="no" aria-hidden=false>{}</div>',
        "<article>{}<aside><article><p>Teaser of another text</p></article></aside></article>",
        '<main>{}<article class="comment"><p>I liked it</p></article><article class=comment>Me too</article></main>',
        '<article>{}<div class="related-posts"><p>More to read</p></div><div class="share-tools">Share it</div></article>',
        '<article>{}</article><aside><article><p>Teaser</p></article></aside>',
        "<div hidden><p>Not shown</p></div><div>{}</div><p hidden=hidden>Nor this</p>",
        '<div>{}</div><section id="comments"><article><p>A long comment of a reader who has a lot to say.</p></article></section>',
        "<DIV CLASS='page'><nav><a href=x>Menu</a></nav>{}</DIV>",
        '<div title="a > b" data-x=\'"\'>{}</div>',
    ],
)
def test_everyday_markup(around):
    assert main_text(f"<html><body>{around.format(TEXT)}</body></html>") == WANT


def test_articles_in_a_main_belong_to_it():
    assert main_text(f"<body><main><article>{TEXT}</article><article>{TEXT}</article></main></body>") == f"{WANT}\n{WANT}"


def test_text_without_article_beside_menus_and_notices():
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Entry {i}</a></li>" for i in range(20)) + "</ul>"
    page = f'<body>{menu}<table><tr><td>{menu}</td><td><div>{TEXT}</div></td></tr></table><div class="cookie-notice">We use cookies</div>{menu}</body>'
    assert main_text(page) == WANT


def test_quotes_and_tags_left_open():
    assert main_text('<p>a</p><a href="x>b</a><p>c</p>') == "a\nb\nc"
    assert main_text("<p>one <b two") == "one <b two"
    assert main_text("<p>a<!-- never closed <p>b") == "a"
    assert main_text("<p>a</p></i></i></b><p>b</p>") == "a\nb"
    assert main_text("<script>x</p>") == ""


BROKEN = {
    "unclosed tags": lambda n: "<b " * n,
    "open quotes": lambda n: '<a href="x ' * n + ">",
    "both quotes": lambda n: "<a '\" " * n + ">x",
    "closed in quotes": lambda n: "<a x='>' \" " * n,
    "deep": lambda n: "<div>" * n + "x" + "</i>" * n,
    "deep with paragraphs": lambda n: "<b>" * n + "<p>x" * n,
    "comments": lambda n: "<!-" * n + "<!--" * n,
    "declarations": lambda n: "<!x" * n,
    "long name": lambda n: "<a" * n,
    "attributes": lambda n: "<a " + "x=1 " * n + ">y</a>",
    "references": lambda n: "&amp" * n,
}


@pytest.mark.parametrize("kind", BROKEN)
def test_broken_pages_take_linear_time(kind):
    main_text(BROKEN[kind](100))
    took = []
    for n in (10_000, 80_000):
        page = BROKEN[kind](n)
        start = time.process_time()
        main_text(page)
        took.append(time.process_time() - start)
    # Eight times the page: far from the 64 times of quadratic work.
    assert took[1] < 24 * took[0] + 0.3, took
