"""Text inside an article whose class names and ids look like page furniture."""

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coverledger.llm import html

TEXT = "A paragraph of the article with enough words in it to count as running text."


def page(inner: str, around: str = "article") -> str:
    return (
        f"<html><body><nav><a href=/>Home</a></nav><{around}><h1>Title</h1><p>{TEXT}</p>{inner}"
        f"<p>{TEXT}</p></{around}><div class='ad-box'>Buy now and save a lot.</div></body></html>"
    )


@pytest.mark.parametrize("around", ["article", "main"])
@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ('<section id="discussion"><p>We discuss.</p></section>', "We discuss."),
        ('<h2 id="how-to-share-files">How to share files</h2>', "How to share files"),
        ('<h2 id="related-work">Related work</h2>', "Related work"),
        ('<div id="ad-hoc-networks"><p>Radio nodes.</p></div>', "Radio nodes."),
        ('<p class="notice">Mind this.</p>', "Mind this."),
        ("<ol><li><a>First source</a><li><a>Second source</a><li><a>Third source</a></ol>",
         "First source\nSecond source\nThird source"),
        ("<table><tr><td><a>a1</a><td><a>b1</a><td><a>c1</a></table>", "a1\nb1\nc1"),
        ("<p><a>One</a> <a>two</a> <a>three</a></p>", "One two three"),
    ],
)
def test_article_text_stays(around, inner, text):
    assert html.main_text(page(inner, around)) == f"Title\n{TEXT}\n{text}\n{TEXT}"


@pytest.mark.parametrize(
    "inner",
    [
        '<div class="share">Tell your friends</div>',
        '<ul class="social-links"><li><a>Here</a><li><a>There</a><li><a>Elsewhere</a></ul>',
        "<aside>Beside</aside>",
        '<section hidden id="x">Never shown</section>',
    ],
)
def test_furniture_in_an_article_still_goes(inner):
    assert html.main_text(page(inner)) == f"Title\n{TEXT}\n{TEXT}"


@pytest.mark.parametrize(
    "inner",
    [
        '<section id="comments"><h2>Comments</h2><p>I say so.</p></section>',
        '<section class="comments"><p>I say so, too.</p></section>',
        '<div class="comment-list"><article><p>And so do I.</p></article></div>',
        '<ol class="commentList"><li><p>One.</p><li><p>Two.</p></ol>',
        '<div id="disqus_thread"><p>Three.</p></div>',
        '<div class="newsletter-box"><p>Write to us and get mail.</p></div>',
        '<div class="cookie-banner"><p>We use cookies.</p></div>',
        '<section class="related-stories"><p>Another story.</p><p>A third one.</p></section>',
    ],
)
def test_boxes_in_and_beside_an_article_go(inner):
    assert html.main_text(page(inner)) == f"Title\n{TEXT}\n{TEXT}"
    beside = f"<body><main><article><h1>Title</h1><p>{TEXT}</p><p>{TEXT}</p></article>{inner}</main></body>"
    assert html.main_text(beside) == f"Title\n{TEXT}\n{TEXT}"


@pytest.mark.parametrize(
    "name", ["post-body skip-intro", "share-price", "comment-open", "ad-hoc", "widget", "modal-content", "headerless"]
)
def test_an_article_is_not_lost_by_a_name(name):
    short = "<div class='box'><p>A short text beside it.</p></div>"
    paragraphs = f"<p>{TEXT}</p>" * 6
    found = html.main_text(f"<html><body><div class='{name}'>{paragraphs}</div>{short}</body></html>")
    assert found.startswith("\n".join([TEXT] * 6))


def test_an_advert_longer_than_the_article_goes():
    advert = f"<div class='ad'>{TEXT} {TEXT} {TEXT}</div>"
    assert html.main_text(f"<body>{advert}<article><h1>Title</h1><p>Short.</p></article></body>") == "Title\nShort."


def test_comments_longer_than_the_article_go():
    remarks = f"<div><p>{TEXT}</p></div>" * 20
    found = html.main_text(f"<body><div class='story'><p>{TEXT}</p><p>{TEXT}</p></div><div id='comments'>{remarks}</div></body>")
    assert found == f"{TEXT}\n{TEXT}"


def test_formulas_are_text():
    formula = "<p>Thus <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds.</p>"
    assert html.main_text(page(formula)) == f"Title\n{TEXT}\nThus x=1 holds.\n{TEXT}"


def plain_measures(node):
    """Characters, link characters, tags and link tags, counted anew for every node."""
    chars = link = tags = links = 0
    for part in node.parts:
        if isinstance(part, str):
            chars += len([c for c in part if not c.isspace()])
        else:
            c, k, t, n = plain_measures(part)
            chars, link, tags, links = chars + c, link + k, tags + t + 1, links + n
    return (chars, chars, tags, 1) if node.tag == "a" else (chars, link, tags, links)


def plain_density(node, page_chars, page_link):
    c, k, t, n = plain_measures(node)
    if not c:
        return 0.0
    t, n, rest = max(t, 1), max(n, 1), max(c - k, 1)
    base = math.log(c * k / rest + page_link / max(page_chars, 1) * c + math.e)
    logarithm = max(math.log(max(c * t / (max(k, 1) * n), 1.0)), 0.0) / math.log(max(base, 1.01) + 1)
    return c / t * logarithm


TREES = st.recursive(
    st.sampled_from(["some words of text ", "more ", "<a href=/x>a link</a>", "<br>"]),
    lambda inner: st.builds(
        lambda tag, parts: f"<{tag}>{''.join(parts)}</{tag}>",
        st.sampled_from(["div", "section", "article", "span", "blockquote"]),
        st.lists(inner, max_size=4),
    ),
    max_leaves=25,
)


@settings(max_examples=100, deadline=None)
@given(st.lists(TREES, min_size=1, max_size=4))
def test_densities_and_choice_against_plain_counting(parts):
    root = html.parse("<body>" + "".join(parts) + "</body>")
    nodes = html.measure(root)
    chars, link, _, _ = plain_measures(root)
    for node in nodes:
        assert node.density == pytest.approx(plain_density(node, chars, link))
        own = [plain_density(p, chars, link) for p in node.parts if isinstance(p, html.Node)]
        assert node.total == pytest.approx(sum(own))
    best = max(node.total for node in nodes)
    [first, *_] = chosen = html.choose(root)
    inside = {id(n) for top in chosen for n in html._nodes(top)}
    assert not best or any(id(n) in inside and n.total == pytest.approx(best) for n in nodes)
    assert first.parent is None or all(p.parent is first.parent for p in chosen)


def test_a_very_long_page_with_text():
    paragraphs = "".join(f"<p>{k} {TEXT}</p>" for k in range(20_000))
    found = html.main_text(page(paragraphs)).split("\n")
    assert len(found) == 20_003 and found[2] == f"0 {TEXT}" and found[-2] == f"19999 {TEXT}"


def test_headings_of_pages_without_article():
    inner = f'<h2 id="related-work">Related work</h2><div id="cookie-notice">Cookies.</div><p>{TEXT}</p>'
    assert html.main_text(page(inner, "div")) == f"Title\n{TEXT}\nRelated work\n{TEXT}\n{TEXT}"
