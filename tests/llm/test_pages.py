"""Whole articles stay: forms around pages, odd markup, deep nesting, headings that pages share."""

import random

import pytest

from despensa.llm import wrappers as w


def on_host(pages):
    marked = w.infer(pages)
    return [w.main_text(p, marked) for p in pages]


def plain(body, n=0):
    return f"<html><head><title>t</title></head><body>{body}</body></html>"


def story(n):
    return "".join(f"<p>Story {n} has a paragraph number {k} of its own words.</p>" for k in range(3))


def lines(n):
    return "\n".join(f"Story {n} has a paragraph number {k} of its own words." for k in range(3))


def test_form_around_the_page():
    page = lambda n: plain(
        '<form id="server" action="/p"><input type="hidden" value="x"><header>Site</header><nav><a href="/">Home</a></nav>'
        f"<article><h1>Title {n}</h1>{story(n)}</article><footer>Imprint</footer></form>")
    assert on_host([page(n) for n in range(5)]) == [f"Title {n}\n{lines(n)}" for n in range(5)]
    assert on_host([page(1)]) == [f"Title 1\n{lines(1)}"]
    # Without any part of a page in it the form is all there is; beside an article it goes.
    assert on_host([plain(f"<form><div>{story(4)}</div></form>")]) == [lines(4)]
    beside = [plain(f"<article>{story(n)}</article><form><p>Your name and mail, please.</p></form>") for n in range(4)]
    assert on_host(beside) == [lines(n) for n in range(4)]
    inside = plain(f"<article>{story(1)}<form><label>Vote</label><p>Pick one</p></form></article>")
    assert on_host([inside]) == [lines(1)]


def test_svg_that_closes_itself():
    page = plain(f'<article><h1>Title</h1><svg class="i" viewBox="0 0 1 1"/>{story(1)}<svg><path d="M0"/></svg><p>End.</p></article>')
    assert on_host([page]) == [f"Title\n{lines(1)}\nEnd."]
    # A script never closes itself.
    assert on_host([plain(f'{story(2)}<script src="a.js"/>var hidden = 1;</script><p>More.</p>')]) == [lines(2) + "\nMore."]


@pytest.mark.parametrize("depth", [10, 149, 150, 399, 500, 3000])
@pytest.mark.parametrize("names", ["", ' class="box"'])
def test_deep_nesting(depth, names):
    page = plain(f"<div{names}>" * depth + f"<article><h1>Story 1 below</h1>{story(1)}</article>" + "</div>" * depth)
    assert on_host([page]) == ["Story 1 below\n" + lines(1)]
    assert on_host([page, page.replace("Story 1", "Story 2"), page.replace("Story 1", "Story 3")])[1] == "Story 2 below\n" + lines(2)


def test_title_in_the_header_of_the_article():
    page = lambda n: plain(
        f"<header><h1>The site</h1></header><article><header><h1>Title {n}</h1></header>{story(n)}"
        "<footer>Shared under a licence</footer></article>")
    assert on_host([page(n) for n in range(4)]) == [f"Title {n}\n{lines(n)}" for n in range(4)]


def recipe(n):
    rng = random.Random(n)
    items = ["salt", *(f"{rng.randint(1, 900)} g of food {n}{k}" for k in range(rng.randint(2, 5)))]
    steps = [f"Step {k} of recipe {n} takes {rng.randint(2, 90)} minutes." for k in range(rng.randint(2, 4))]
    body = (f"<h1>Recipe {n}</h1><p>About dish {n} and where it comes from, at some length.</p><h2>Ingredients</h2><ul>"
            + "".join(f"<li>{x}</li>" for x in items) + "</ul><h2>Method</h2><p>You do this:</p><ol>"
            + "".join(f"<li>{x}</li>" for x in steps) + "</ol><p>Good luck with dish number " + str(n) + "!</p>")
    want = [f"Recipe {n}", f"About dish {n} and where it comes from, at some length.", "Ingredients", *items, "Method",
            "You do this:", *steps, f"Good luck with dish number {n}!"]
    page = plain("<nav><a href='/'>Home</a></nav><article><p>This page uses cookies of our partners.</p>" + body
                 + "<p>All recipes are tested by us.</p><p>Follow us on all channels.</p></article><footer>Imprint</footer>")
    return page, "\n".join(want)


def test_headings_and_items_that_pages_share():
    """30 pages of a host: only lines of the template go, before and after what the pages say."""
    pages, want = zip(*(recipe(n) for n in range(30)))
    assert on_host(list(pages)) == list(want)


def test_advert_between_paragraphs():
    page = lambda n: plain(f"<article><p>Story {n} begins with words of its own.</p><p>Buy our coffee, it is good.</p>"  # noqa: E731
                           f"<p>Story {n} goes on and comes to an end.</p></article>")
    assert on_host([page(n) for n in range(6)]) == [
        f"Story {n} begins with words of its own.\nStory {n} goes on and comes to an end." for n in range(6)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@pytest.mark.parametrize("cells", [1, 20, 1_000_000])
def test_alignment_is_exact_at_every_size(monkeypatch, cells):
    monkeypatch.setattr(w, "CELLS", cells)
    rng = random.Random(cells)
    for n in range(150):
        a = [rng.choice("abcde") for _ in range(rng.randint(0, 18))]
        b = [rng.choice("abcde") for _ in range(rng.randint(0, 18))]
        found = w.pairs(a, b)
        assert len(found) == lcs(a, b) and all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def test_long_lists_of_kinds():
    a = [f"p k{i % 700}" for i in range(1500)]
    b = [x for i, x in enumerate(a) if i % 7] + ["p other"]
    assert len(w.pairs(a, b)) == sum(1 for i in range(1500) if i % 7)
