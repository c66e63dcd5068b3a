"""Main text of web pages by container paths that the pages of a host agree on."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.session import stage

# HTML elements by what they do to text.
SKIPPED = frozenset(
    "head title nav footer aside form button select option textarea input label fieldset"
    " menu dialog iframe object audio video canvas map".split()
)
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Words in class and id names that mark what is no part of an article.
NOISE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup"
    " login popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar side"
    " aside footer foot comment comments commentlist disqus respond replies share sharing social"
    " related recommended recommendations pagination pager toolbar widget widgets skip hidden"
    " search searchform".split()
)
# These count only in names made of such words and names of boxes: not hidden-xs, search-results.
WEAK_WORDS = frozenset("hidden search side share skip foot promotion notice notices".split())
BOX_WORDS = frozenset(
    "area bar block box button buttons container form icon icons inner input link links list"
    " panel section wrap wrapper".split()
)
# A name that begins with one of these tells of the element's look, not of what it is.
STATE_WORDS = frozenset("with without has no not non is hide show".split())
# Parts that may hold articles of their own, and still are none.
ASIDE_WORDS = frozenset(
    "comment comments commentlist disqus respond replies related recommended recommendations".split()
)
# These mark a page's own top, but inside an article they hold its heading.
HEAD_WORDS = frozenset("header masthead topbar".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(?:svg|math)\b[^>]*/>
    |<(?P<raw>script|style|noscript|template|svg|math)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)
    |<[!?/][^>]*(?:>|\Z)
    |(?P<text>[^<]+|<)""",
    re.X | re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
DEPTH_SHARE = 0.5
# A marked element with this share of all text, on a page without article and main, is none.
WRAPPER_SHARE = 0.9
# What a container adds to the one inside it is article text up to this share of link text.
LINK_SHARE = 0.3


@dataclass
class Element:
    tag: str
    path: str
    noise: bool
    in_article: bool
    number: int
    text: float = 0.0  # characters of running text, a deeper one's counted in part
    links: float = 0.0
    parent: int = 0  # the container around it
    marks: tuple[int, ...] = ()  # names around it that mark noise; see Mark
    hard: bool = False  # noise by tag or attribute, whatever it holds
    whole: int = 0  # characters of running text, deeper ones' in full
    whole_links: int = 0


@dataclass
class Mark:
    """An element whose class or id name says that it is no part of an article."""

    aside: bool  # a part such as comments, which may hold articles of its own
    size: int = 0
    articles: int = 0


@dataclass
class Part:
    """A piece of text, with what marks it as noise and whether it is in a link."""

    text: str
    hard: bool
    marks: tuple[int, ...]
    linked: bool


@dataclass
class Block:
    """A run of text with the containers it stands in, outermost first. After parsing, its
    parts are the texts that are no noise; ``noise`` says that there is none."""

    parts: list
    inside: tuple[int, ...]
    noise: bool = False
    linked: int = 0


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    marks: list[Mark] = field(default_factory=list)
    articles: int = 0


def _attributes(rest: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _is_hard_noise(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Noise by tag or attribute."""
    if tag in SKIPPED or (tag == "header" and not in_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if attributes.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search"):
        return True
    return bool(_HIDDEN.search(attributes.get("style", "")))


def _mark(tag: str, attributes: dict[str, str], in_article: bool) -> Mark | None:
    """A mark if one of the element's names, taken whole, says noise."""
    if tag in ("html", "body", "article", "main"):
        return None
    names = (attributes.get("class", "") + " " + attributes.get("id", "")).split()
    for name in names:
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or words[0] in STATE_WORDS:
            continue
        found = NOISE_WORDS.intersection(words)
        if found and found <= WEAK_WORDS and not (NOISE_WORDS | BOX_WORDS).issuperset(words):
            continue
        if found or (not in_article and HEAD_WORDS.intersection(words)):
            return Mark(bool(ASIDE_WORDS & found))
    return None


def _step(tag: str, attributes: dict[str, str]) -> str:
    """A path step: tag and classes, numbers generalised, so that pages of a site agree."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def parse(source: str | None) -> Page:
    """Containers and text blocks of a page, in page order. Broken markup is no error."""
    page = Page()
    root = Element("", "", False, False, 0)
    page.elements.append(root)
    stack: list[Element] = [root]
    block: Block | None = None
    linking = 0

    def close(index: int) -> None:
        nonlocal linking
        for element in stack[index:]:
            linking -= element.tag == "a"
        del stack[index:]

    for token in _TOKEN.finditer(source or ""):
        text = token["text"]
        if text is not None:
            if block is None:
                inside = tuple(e.number for e in stack if e.number >= 0)
                block = Block([], inside)
                page.blocks.append(block)
            block.parts.append(Part(text, stack[-1].hard, stack[-1].marks, linking > 0))
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS or tag in SKIPPED:
            block = None
        if token["end"]:
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag == tag:
                    close(index)
                    break
                # An inline end tag does not close the block around it.
                if tag not in BLOCKS and tag not in SKIPPED and stack[index].tag in BLOCKS:
                    break
            continue
        if tag == "body":  # ends a head that was not closed
            close(next((i for i, e in enumerate(stack) if e.tag == "head"), len(stack)))
        if tag in BLOCKS:  # a block ends an open paragraph
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag == "p":
                    close(index)
                    break
                if stack[index].tag in CONTAINERS:
                    break
        if tag in VOID:
            continue
        above = stack[-1]
        attributes = _attributes(token["rest"]) if token["rest"].strip() else {}
        hard = above.hard or _is_hard_noise(tag, attributes, above.in_article)
        marks = above.marks
        mark = _mark(tag, attributes, above.in_article) if attributes and not hard else None
        if mark:
            marks = (*marks, len(page.marks))
            page.marks.append(mark)
        if tag in ("article", "main") and not hard and not any(page.marks[n].aside for n in marks):
            page.articles += 1
            for number in marks:
                page.marks[number].articles += 1
        in_article = above.in_article or tag in ("article", "main")
        linking += tag == "a"
        if tag in CONTAINERS:
            path = f"{above.path}/{_step(tag, attributes)}"
            element = Element(tag, path, False, in_article, len(page.elements))
            page.elements.append(element)
        else:
            element = Element(tag, above.path, False, in_article, -1)
        element.parent = above.number if above.number >= 0 else above.parent
        element.marks, element.hard = marks, hard
        stack.append(element)
    _settle(page)
    return page


def _settle(page: Page) -> None:
    """Decide which marks hold, once the whole page is known, and drop the noise from blocks.

    A mark falls if every article of the page is inside its element, or, on a page without one,
    nearly all text: then its name is that of the layout. Comments and the like stay marked.
    """
    total = 0
    for block in page.blocks:
        for part in block.parts:
            size = 0 if part.hard else len(part.text.strip())
            total += size
            for number in part.marks:
                page.marks[number].size += size
    live = set()
    for number, mark in enumerate(page.marks):
        whole = mark.articles == page.articles if page.articles else mark.size >= WRAPPER_SHARE * total
        if mark.aside or not whole:
            live.add(number)
    for element in page.elements:
        element.noise = element.hard or not live.isdisjoint(element.marks)
    for block in page.blocks:
        kept = [p for p in block.parts if not p.hard and live.isdisjoint(p.marks)]
        block.parts = [p.text for p in kept]
        block.linked = sum(len(p.text) for p in kept if p.linked)
        block.noise = not kept


def block_text(block: Block) -> str:
    """References decoded, white space turned into single spaces, trimmed."""
    return " ".join(html.unescape("".join(block.parts)).split())


def best_container(page: Page) -> tuple[str, float] | None:
    """Path and score of the container that holds the article, judged by this page alone.

    Text counts in full for the container it stands in and by halves further out, so the
    tightest container of most of the text wins; text of links counts against it. The path
    returned is that of the article around the winner, see ``_climb``.
    """
    for block in page.blocks:
        if block.noise:
            continue
        size, share = len(block_text(block)), 1.0
        for number in reversed(block.inside):
            page.elements[number].text += share * size
            page.elements[number].links += share * min(block.linked, size)
            page.elements[number].whole += size
            page.elements[number].whole_links += min(block.linked, size)
            share *= DEPTH_SHARE
    # Containers of one path are one candidate: an article may be cut into several.
    scores: dict[str, float] = {}
    for element in page.elements:
        if element.text > 0 and not element.noise:
            scores[element.path] = scores.get(element.path, 0.0) + element.text - 2 * element.links
    if not scores:
        return None
    path, score = max(scores.items(), key=lambda x: (x[1], x[0]))
    return _climb(page, path), score


def _climb(page: Page, path: str) -> str:
    """Path of the article around the containers of ``path``: lead, heading and tables too.

    That is the nearest article or main element, if what it adds is not mostly links.
    Otherwise the containers around are taken one by one, below the body, as long as that
    holds for what each adds.
    """
    size: dict[str, int] = {}
    links: dict[str, int] = {}
    first: dict[str, Element] = {}
    for element in page.elements:
        size[element.path] = size.get(element.path, 0) + element.whole
        links[element.path] = links.get(element.path, 0) + element.whole_links
        first.setdefault(element.path, element)

    def adds_text(outer: str, inner: str) -> bool:
        return links[outer] - links[inner] <= LINK_SHARE * (size[outer] - size[inner])

    steps, element = [], first[path]
    while element.tag not in ("article", "main"):
        element = page.elements[element.parent]
        if element.tag in ("", "html", "body"):
            break
        steps.append(element.path)
    else:
        if steps and adds_text(steps[-1], path):
            return steps[-1]
    for outer in steps:
        if not adds_text(outer, path):
            break
        if size[outer] > size[path]:
            path = outer
    return path


def extract(page: Page, path: str) -> str:
    """The text of all containers with this path, without what marks itself as no article."""
    chosen = {e.number for e in page.elements if e.path == path}
    texts = [
        block_text(b) for b in page.blocks if not b.noise and not chosen.isdisjoint(b.inside)
    ]
    return "\n".join(t for t in texts if t)


def host(url: Column) -> Column:
    """Host of an address in lower case; '' if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def vote_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the container path that most pages of a host rank first.

    Ties go to the larger total score, then to the path. Votes are counted before they are
    shuffled, so a host with a third of all pages sends a row per path and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                best = best_container(parse(source))
                if best:
                    hosts.append(name)
                    paths.append(best[0])
                    scores.append(round(best[1]))  # whole numbers add up alike in any order
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64())],
                names=["host", "path", "score"],
            )

    votes = pages.select("host", "html").mapInArrow(run, "host string, path string, score bigint")
    counted = votes.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score")
    )
    return counted.groupBy("host").agg(
        F.max_by("path", F.struct("votes", "score", "path")).alias("path")
    )


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, text, n_chars.

    The text is that of the containers on the path its host agreed on; a page without such
    a container, or with no text in it, is read by its own best container. Menus, page
    headers, footers, sidebars, notices, adverts, forms, comments, scripts and hidden parts
    are left out. Blocks are joined by a line feed. NULL and empty pages have the text '';
    a NULL url is a host of its own; repeated rows are pages of their own; other columns are
    not read.
    """
    narrow = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        host(F.col(url_col)).alias("host"),
    )
    winners = stage(vote_paths(narrow), "host-paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for path, source in zip(batch.column("path").to_pylist(), batch.column("html").to_pylist()):
                page = parse(source)
                text = extract(page, path) if path is not None else ""
                if not text:
                    best = best_container(page)
                    text = extract(page, best[0]) if best else ""
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    kinds = dict(narrow.dtypes)
    # Few hosts are broadcast; with many, adaptive execution splits a frequent host.
    read = narrow.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return read.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string").select(
        F.col("page_id").alias(id_col),
        F.col("url").alias(url_col),
        "text",
        F.char_length("text").cast("bigint").alias("n_chars"),
    )
