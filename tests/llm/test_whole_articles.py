"""No part of an article is lost to a deeper container."""

import pytest

from larder.llm import articles

WORDS = "Some running text of an article. "
LINKS = "<a href=x>" + WORDS * 6 + "</a>"


@pytest.mark.parametrize(
    "source, expected",
    [
        (f"<article><h1>Title</h1><div class='entry-content'><p>{WORDS * 9}</div></article>",
         ["Title", WORDS * 9]),
        (f"<article><div class=lead>{WORDS * 9}</div><div class=body>{WORDS * 30}</div></article>",
         [WORDS * 9, WORDS * 30]),
        (f"<article><p>{WORDS * 30}</p><table><tr><td>{WORDS * 25}</td><td>{WORDS * 15}</td></tr>"
         "</table></article>", [WORDS * 30, WORDS * 25, WORDS * 15]),
        (f"<body><div class=page><h1>Title</h1><div class=text><p>{WORDS * 9}</div></div></body>",
         ["Title", WORDS * 9]),
        # A list of links beside the text, and text outside the article, stay out.
        (f"<body><div class=page><div class=text><p>{WORDS * 9}</div><div>{LINKS}</div></div></body>",
         [WORDS * 9]),
        (f"<main><p>{WORDS * 2}</p><article><h1>T</h1><section>{WORDS * 9}</section></article></main>",
         ["T", WORDS * 9]),
        (f"<main><div class=x><h2>T</h2><div class=w-1/2>{WORDS * 9}</div></div><div>{LINKS}</div></main>",
         ["T", WORDS * 9]),
        # Names of layouts are no noise, and an icon that closes itself hides nothing.
        (f"<div class='layout with-sidebar'><article><p>{WORDS * 9}</p></article><div class=sidebar>x</div></div>",
         [WORDS * 9]),
        (f"<div class='page-sidebar-left'><article><p>{WORDS * 9}</p></article></div>", [WORDS * 9]),
        (f"<div id=search-results class='no-ads hidden-xs'><div class=text><p>{WORDS * 9}</div></div>", [WORDS * 9]),
        (f"<svg class='i'/><article><math display='x'/><p>{WORDS * 9}</p></article>", [WORDS * 9]),
        # Noise inside a block is left out, the block is not.
        (f"<article><p><span class='share'>Share</span> {WORDS * 9}</p></article>", [WORDS * 9]),
        (f"<article><p>Begin <span hidden>SECRET</span> end. {WORDS * 9}</p></article>",
         ["Begin end. " + WORDS * 9]),
        # Comments stay out though they hold articles of their own, also where the text has none.
        (f"<article><p>{WORDS * 9}</p></article><div class=comments><article>{WORDS * 20}</article></div>",
         [WORDS * 9]),
        (f"<div class=post><p>{WORDS * 9}</p></div><div id=comments><article>{WORDS * 3}</article></div>",
         [WORDS * 9]),
        (f"<div class=related-posts><article>{WORDS}</article></div><article><p>{WORDS * 9}</p></article>",
         [WORDS * 9]),
        (f"<article><p>{WORDS * 9}</p><div class=share-buttons>Tweet</div><div class=ad-box>Buy</div></article>",
         [WORDS * 9]),
    ],
)
def test_whole_article(source, expected):
    page = articles.parse(source)
    path, _ = articles.best_container(page)
    assert articles.extract(page, path) == "\n".join(x.strip() for x in expected)
