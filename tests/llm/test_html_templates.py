"""Template removal against a brute-force version, and marks that are names."""

from __future__ import annotations

import random
from collections import defaultdict
from xml.etree import ElementTree

import pytest

from martflow.llm.html_extract import MANY_PAGES, main_text, parse

CONTAINERS = ("div", "section", "ul")
BLOCKS = ("p", "li", "h2")


def site(seed):
    """Well-formed pages of a few hosts; boxes recur on some pages of their host."""
    rng = random.Random(seed)
    pages = []
    for host in range(4):
        boxes = [f"<div class='b'><p>box {host} {k}</p><ul><li>x{k}</li><li>y</li></ul></div>" for k in range(4)]
        boxes.append("<section><p>the same everywhere</p></section>")
        for i in range(rng.choice([3, 12, 60])):
            parts = [f"<p>story {host} {i} {rng.random()}</p>", "<p>Read on.</p>"]
            for k, box in enumerate(boxes):
                if rng.random() < (0.05, 0.3, 0.9, 0.1, 0.5)[k]:
                    parts.insert(rng.randrange(len(parts) + 1), box)
            if rng.random() < 0.2:      # nested, and the larger part of its page
                parts = [f"<div>{boxes[2]}<p>n {i}</p></div>"] + parts[:1]
            pages.append((len(pages), f"http://h{host}.org/{i}", f"<html><body><article>{''.join(parts)}</article></body></html>"))
        pages += [(len(pages) + k, f"http://h{host}.org/copy{k}", pages[-1][2]) for k in range(7)]    # copies count once
    return pages


def blocks_of(element, inside=()):
    """Text blocks of an article with the container subtrees around them."""
    own = inside
    if element.tag in CONTAINERS:
        own = inside + (ElementTree.tostring(element),)
    if element.tag in BLOCKS:
        return [(element.text, own)]
    return [b for child in element for b in blocks_of(child, own)]


def brute(pages):
    parsed = {i: (url.split("/")[2], blocks_of(ElementTree.fromstring(html)[0][0])) for i, url, html in pages}
    seen = defaultdict(set)
    for host, blocks in parsed.values():
        content = "\n".join(t for t, _ in blocks)
        for _, own in blocks:
            for tree in own:
                seen[host, tree].add(content)
    return {i: "\n".join(t for t, own in blocks if not any(len(seen[host, tree]) >= MANY_PAGES for tree in own))
            for i, (host, blocks) in parsed.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_template_removal_equals_brute_force(spark, seed):
    pages = site(seed)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in main_text(frame).collect()}
    want = brute(pages)
    assert got == want
    assert any("box" in t for t in want.values()) and any("box" not in t for t in want.values())


@pytest.mark.parametrize("attribute", [
    "class='share-price-table'", "class='form-of-life'", "class='login-shell'", "class='alert-level'", "id='menu-a-la-carte'",
    "class='notice'", "class='widget'", "class='advertisement-history'"])
def test_article_text_under_names_that_only_look_like_marks_stays(attribute):
    html = f"<html><body><article><p>a</p><div {attribute}><p>b</p></div></article></body></html>"
    assert [t for t, _ in parse(html)[0]] == ["a", "b"]


@pytest.mark.parametrize("attribute", ["class='ad'", "class='x sidebar'", "id='comments'", "role='navigation'"])
def test_marks_are_dropped_in_an_article(attribute):
    html = f"<html><body><article><p>a</p><div {attribute}><p>b</p></div></article></body></html>"
    assert [t for t, _ in parse(html)[0]] == ["a"]


@pytest.mark.parametrize("attribute", ["class='notice'", "class='login'", "class='topbar'", "class='alert'"])
def test_marks_outside_an_article(attribute):
    html = f"<html><body><div {attribute}><p>b</p></div><p>a</p></body></html>"
    assert [t for t, _ in parse(html)[0]] == ["a"]
