"""Work per text grows in proportion to it, also where texts are made to make it grow faster; and what whole names drop of a page."""

import random
import time

import pytest

from spindrel.llm import html, pii, secrets, spans


def timed(f, *args):
    began = time.process_time()
    out = f(*args)
    return time.process_time() - began, out


def test_contexts_of_a_contact_list():
    text = " ".join(f"person{i} person{i}@example{i % 97}.com +1 212 555 {i:07d}" for i in range(18_000))
    assert len(text) > 900_000
    found = spans.personal(text)
    assert len(found) >= 18_000
    took, contexts = timed(pii._around, text, found, 8, 4)
    assert took < 8 and len(contexts) >= 18_000
    terms, _, _ = pii._terms(text, found, 4)
    assert len(terms) > 10_000


def plain_around(text, found, a, b):
    return not any(a < y and x < b for x, _, y in found)


def test_contexts_are_those_of_a_plain_search():
    r = random.Random(4)
    for _ in range(60):
        text = " ".join(r.choice(["word", "longer", "x@y.com", "a.b@c.org", "1.2.3.4", "+12 345 678 901", "it"]) for _ in range(r.randrange(60)))
        found = spans.personal(text)
        near = pii._around(text, found, 3, 2)
        for s, k, e in found:
            assert pii._hash(f"{spans.PII_KINDS[k]}:{text[s:e].lower()}") in near
        if found:
            _, starts, ends = pii._terms(text, found, 2)
            assert all(plain_around(text, found, a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True))


def test_random_tokens_beside_many_spans():
    tokens = [(i * 50 + 5, 3, i * 50 + 30, "v") for i in range(50_000)]
    base = [(i * 50 + (40 if i % 2 else 10), 0, i * 50 + 45, "b") for i in range(50_000)]
    took, kept = timed(secrets._apart, tokens, base)
    assert took < 3 and kept == [t for i, t in enumerate(tokens) if i % 2]
    r = random.Random(1)
    for _ in range(300):
        spread = lambda n: [(s, 0, s + r.randrange(1, 9), "") for s in (r.randrange(60) for _ in range(n))]  # noqa: B023, E731
        tokens, base = spread(8), spread(6)
        assert secrets._apart(tokens, base) == [t for t in tokens if not any(t[0] < b[2] and b[0] < t[2] for b in base)]


@pytest.mark.parametrize("page", [
    "<b><div>" + "<i>" * 20_000 + "</b>" * 20_000 + "text", "<a><div></a>" * 20_000 + "text", "<b><p>" * 20_000 + "</b>" * 20_000, "<i>" * 40_000 + "</b></i>" * 20_000,
    "<a href=x><div>" * 10_000 + "</a>" * 10_000, "<ul>" + "<li><b>" * 20_000 + "</b></ul>",
])
def test_stray_ends_in_linear_time(page):
    took, _ = timed(html.main_text, page)
    assert took < 6


LONG = "This paragraph is part of the article, with commas, and enough words to be read as one of its own."


def page(inside, around=""):
    return f"<html><body><div class='site-header'>Top of all pages</div><main><article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p>{inside}<p>{LONG}</p></article></main>{around}</body></html>"


@pytest.mark.parametrize("part", [
    '<section class="social-history"><p>A social history of the town.</p></section>', '<table class="widget-prices"><tr><td>Widgets cost ten.</td></tr></table>', '<div id="reply-to-critics"><p>A reply to the critics.</p></div>',
    '<p>It was made <span class="ad-hoc">ad hoc</span> then.</p>', '<p>They looked for <em class="search-term">a term</em> once.</p>', '<p>An <b id="comment">inline remark</b> here.</p>', '<div class="notice-of-the-court"><p>The court gave notice.</p></div>',
])
def test_text_of_the_article_stays(part):
    import re

    words = " ".join(re.sub("<[^>]*>", "", part).split())
    assert words in html.main_text(page(part))


@pytest.mark.parametrize("name", ["ad", "ads", "sidebar", "sidebar-left", "site-header", "comment-list", "related-posts", "share-buttons", "cookie_notice", "newsletter-signup", "ad banner-2", "social links"])
def test_parts_with_whole_names_go(name):
    inside, after = f'<div class="{name}"><p>Something else entirely, by the way.</p></div>', f'<div id="{name.replace(" ", "-")}"><p>Something else entirely, after it.</p></div>'
    got = html.main_text(page(inside, after))
    assert "Something else" not in got and "Top of all pages" not in got and got.count(LONG) == 3
