"""Extraction of main texts: broken markup, wrappers, and densities against their definition."""

from __future__ import annotations

import math
import random
import time

import pytest

from lapledger.llm import html

TEXT = "A paragraph of the article that goes on for a while, as such paragraphs do, so that it is long."
ARTICLE = f"<h1>Title</h1><p>{TEXT}</p><p>{TEXT} Again.</p><p>Short.</p><ul><li>One<li>Two</ul>"
EXPECTED = f"Title\n{TEXT}\n{TEXT} Again.\nShort.\nOne\nTwo"
AROUND = '<nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>', "<footer>&copy; me</footer>"


def page(inside):
    return f"<html><body>{AROUND[0]}{inside}{AROUND[1]}</body></html>"


def test_broken_markup_never_fails():
    r = random.Random(1)
    parts = ["<", "<!", "<![", "]]>", "]>", "foo", "[", "-->", "--!>", "<!--", "<!-->", "<p", "</p", ">", "&#x;", "&amp", "&#99999999999;", "<script>"]
    parts += ["</script>", "<a href='", '"', "'", " ", "=", "<?", "?>", "<div>", "</div>", "<li>", "<!DOCTYPE html [ <!ENTITY x 'y'> ]>", "\x00", "é", "<![CDATA[ x ]]>"]
    for _ in range(20_000):
        assert isinstance(html.text_of("".join(r.choice(parts) for _ in range(r.randint(1, 14)))), str)


@pytest.mark.parametrize(
    "markup, text",
    [
        ("<p>a</p><![foo[ x ]]><p>b", "a\nb"),
        ("<p>a</p><!-- x", "a"),
        ("<p>a</p><!--> b", "a\nb"),
        ("<p>a</p><!-- x --!><p>b", "a\nb"),
        ("<!DOCTYPE html [<!ENTITY x 'y'>]><p>a", "a"),
        ("<!doctype html><p>a", "a"),
        ("<p>a<![CDATA[ > ]]> b", "a b"),
        ("<p>a<!x>b<?y?>c", "abc"),
        ("<!", ""),
    ],
)
def test_declarations_and_comments_are_no_text(markup, text):
    assert html.text_of(markup) == text


@pytest.mark.parametrize(
    "name", ["content has-sidebar", "post no-comments", "layout--with-ads", "share-story", "post-login-required", "main-content comment-enabled", "related-wrapper", "hasSidebar", "nav2-page"]
)
def test_a_wrapper_is_no_aside(name):
    for inside in (ARTICLE, f"<article>{ARTICLE}</article>"):
        assert html.text_of(page(f'<div class="{name}">{inside}</div>')) == EXPECTED
        assert html.text_of(page(f'<div id="outer-menu-area"><div class="{name}">{inside}</div></div>')) == EXPECTED
    assert html.text_of(page(f'<article class="{name}">{ARTICLE}</article>')) == EXPECTED


def test_a_page_in_a_form():
    assert html.text_of(f"<html><body><form action=x>{AROUND[0]}{ARTICLE}<input><button>Go</button>{AROUND[1]}</form></body></html>") == EXPECTED


@pytest.mark.parametrize("name", ["comment-list", "site-sidebar", "cookie-notice", "ad-box", "comments", "ad", "newsletter"])
def test_what_stands_beside_the_article_goes(name):
    beside = f'<div class="{name}"><p>{TEXT} {TEXT}</p><p>{TEXT}</p></div>'
    assert html.text_of(page(ARTICLE.join(["<div>", "</div>"]) + beside)) == EXPECTED
    assert html.text_of(page(f"<form><p>{TEXT}</p></form><div>{ARTICLE}</div>")) == EXPECTED


def test_a_page_of_parts_that_are_aside_has_no_text():
    assert html.text_of(page('<div class="cookie-notice">We use cookies.</div><div class="ad">Buy this now.</div>')) == ""


def test_density_decides_without_article_or_main():
    links = "<div>" + "".join(f'<div><a href="/{i}">Another story of ours {i}</a></div>' for i in range(30)) + "</div>"
    assert html.text_of(f"<html><body>{links}<div><div>{ARTICLE}</div></div>{links}</body></html>") == EXPECTED


def plain(page, node):
    """Characters, characters in links, tags and link tags below a node, by recursion."""
    children = [i for i in range(1, len(page.tags)) if page.parents[i] == node and not page.left_out[i]]
    chars = sum(len("".join(t.split())) for _, n, t in page.texts if n == node)
    at, linked = node, False
    while at > 0:
        linked |= page.tags[at] == "a"
        at = page.parents[at]
    result = [chars, chars if linked else 0, 0, 0]
    for child in children:
        below = plain(page, child)
        result = [a + b for a, b in zip(result, (*below[:2], below[2] + 1, below[3] + (page.tags[child] == "a")))]
    return result


def test_densities_follow_their_definition():
    r = random.Random(3)
    for _ in range(40):
        body = "".join(r.choice([f"<p>{TEXT[: r.randint(1, 90)]}</p>", '<a href="/x">link</a>', "<div>", "</div>", "<ul><li>x</ul>", "<b>bold</b>", '<div class="ad">x</div>']) for _ in range(25))
        page = html.Page(f"<html><body>{body}</body></html>")
        density, total, links = html.densities(page)
        chars, in_links, *_ = plain(page, 0)
        share = in_links / chars if chars else 0.0
        expected = []
        for i in range(len(page.tags)):
            c, lc, t, lt = plain(page, i)
            if i and c and not page.left_out[i]:
                t, lt = max(t, 1), max(lt, 1)
                value = c / t * max(0.0, math.log(c * t / (max(lc, 1) * lt) + 1e-9)) / math.log(math.e + c * lc / max(c - lc, 1) + share * c)
            else:
                value = 0.0
            expected.append(value)
            if i and not page.left_out[i]:
                assert links[i] == lc
        assert density == pytest.approx(expected)
        sums = [sum(expected[j] for j in range(1, len(page.tags)) if page.parents[j] == i) for i in range(len(page.tags))]
        assert total == pytest.approx(sums)


@pytest.mark.parametrize("markup", ["<span>" * 20_000 + "<p>x" * 4_000, "<span>" * 20_000 + "</i>" * 20_000, "<div class='a-nav'>" * 2_000 + "x" * 400, "<p>" + "word " * 400_000])
def test_deep_and_long_pages_take_time_in_proportion(markup):
    start = time.perf_counter()
    html.text_of(markup)
    assert time.perf_counter() - start < 10
