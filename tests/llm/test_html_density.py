"""Densities decide which subtree is the main text: sums by recursion, and pages that no name rule settles."""

import math

import pytest

from threadmill.llm import html_text as H

LONG = "Plain words of the article go on for quite a while, sentence after sentence, with commas and full stops. " * 3
LINKS = "".join(f'<li><a href="/{i}">Some other headline number {i} that is long</a></li>' for i in range(12))
TITLE = "A heading of the article that says what follows"
WANT = "\n".join([TITLE, LONG.strip(), LONG.strip()])
TEXT = f"<h1>{TITLE}</h1><p>{LONG}</p><p>{LONG}</p>"

PAGES = {
    "article beside a list of links": f"<html><body><div class=x1><ul>{LINKS}</ul></div><article>{TEXT}</article></body></html>",
    "article after and before links": f"<html><body><div><ul>{LINKS}</ul></div><article>{TEXT}</article><div><ul>{LINKS}</ul></div></body></html>",
    "plain containers": f"<html><body><div class=x1><ul>{LINKS}</ul></div><div class=x2>{TEXT}</div><div class=x3><ul>{LINKS}</ul></div></body></html>",
    "nested containers": f"<html><body><div><div><ul>{LINKS}</ul></div><div><section>{TEXT}</section></div></div></body></html>",
    "article that holds a list of links": f"<html><body><article><div>{TEXT}</div><div><ul>{LINKS}</ul></div></article></body></html>",
    "articles of links around": f"<html><body><article><ul>{LINKS}</ul></article><article>{TEXT}</article></body></html>",
}


@pytest.mark.parametrize("name", PAGES)
def test_densities_decide(name, monkeypatch):
    assert H.main_text(PAGES[name]) == WANT
    measure = H._measure

    def constant(root):
        nodes = measure(root)
        for n in nodes:
            n.density = n.sum = 1.0
        return nodes

    monkeypatch.setattr(H, "_measure", constant)
    assert H.main_text(PAGES[name]) != WANT


def test_a_paragraph_is_not_the_whole_text():
    assert H.main_text(f"<body><article><h1>Short one</h1><p>{LONG}</p></article></body>") == f"Short one\n{LONG.strip()}"
    assert H.main_text(f"<body><div><h1>Short one</h1><p><b>{LONG}</b></p></div></body>") == f"Short one\n{LONG.strip()}"
    assert H.main_text("<p>only") == "only"
    assert H.main_text("only text") == "only text"


def test_article_says_how_far_the_text_goes():
    page = f"<body><article><header><h1>T</h1></header><div><p>{LONG}</p><p>{LONG}</p></div><p>End.</p></article></body>"
    assert H.main_text(page) == "\n".join(["T", LONG.strip(), LONG.strip(), "End."])


def _totals(n):
    """(characters, tags, link characters, link tags) by plain recursion."""
    c = t = lc = lt = 0
    for k in n.kids:
        if isinstance(k, str):
            c += len(k.strip())
        elif not k.cut:
            kc, kt, klc, klt = _totals(k)
            c, t, lc, lt = c + kc, t + kt + 1, lc + klc, lt + klt
    return (c, t, c, t + 1) if n.tag == "a" else (c, t, lc, lt)


@pytest.mark.parametrize("name", PAGES)
def test_densities_by_recursion(name):
    root = H.parse(PAGES[name])
    nodes = H._measure(root)
    c, _, lc, _ = _totals(root)
    share = lc / c
    for n in nodes:
        c, t, lc, lt = _totals(n)
        assert (n.chars, n.tags, n.links, n.link_tags) == (c, t, lc, lt)
        if c and (lc or share):
            base = math.log(lc * c / max(c - lc, 1) + share * c + math.e) if lc else None
            if base:
                want = c / max(t, 1) * max(math.log(max(c / lc * max(t, 1) / lt, 1)), 0) / math.log(base)
                assert n.density == pytest.approx(want, rel=1e-6)
        assert n.density >= 0
        inner = [k.density for k in n.kids if isinstance(k, H._Node) and not k.cut]
        assert n.sum == pytest.approx(sum(inner) if any(inner) else n.density)
