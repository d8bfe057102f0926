"""Main text of web pages, with the templates of a site removed.

Every block element's subtree is hashed.  Spark counts, for each host, on how many different pages a
subtree occurs; one that is on `MANY` of them, or on half of the pages of a smaller host (four at least),
belongs to the site's template and is deleted.  The bound doesn't rise with the host, so that the
template of one section of a large site goes too; copies of a page count once, so that copying a page
makes no template of it.  Inside an article only containers are deleted so, never its paragraphs or
headings: a passage that many articles quote is still theirs.  What a page marks as a menu, an advert, a
form and so on, by its elements, classes or roles, is deleted as well.

What is moved: one row of two hashes and the host for each block element of each different page, counted
by host and subtree; then, for each page, those of its own subtrees that are template, joined by host and
the page's hash to its outline.  That is what may be main text, without what goes whatever the templates
are, and with the hashes of the containers that only go if they are one; the html itself is never
shuffled.  All joins are sort-merge joins, so that no size of table has a plan of its own.  No list grows
with a host, and Spark splits a hot page's join.

Defined cases: a null or empty html has the empty text; a page without markup is one block; a null
url is the host ''; repeated rows count as one page and each has a row; other columns are
not looked at; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Container, Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.llm.html import BLOCK, BREAK, END, Element, hash_subtrees, parse, pieces, walk
from ledgerline.session import kept

SHARE, LEAST_PAGES, MANY = 0.5, 4, 20

DROPPED = frozenset(
    "script style noscript template head title meta link nav footer aside form iframe object embed svg "
    "canvas audio video button select textarea input dialog menu noembed noframes applet map".split()
)
#: Words of classes, ids and roles that mark what isn't the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored promo "
    "promos promotion sidebar sidebars menu menus menubar nav navbar navigation breadcrumb breadcrumbs footer "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist reply replies discussion disqus respond widget widgets toolbar pagination pager copyright "
    "contentinfo complementary search dialog alertdialog hidden".split()
)
#: These mark something that isn't the article even if it consists of articles.
LIST_MARKS = frozenset(
    "comment comments commentlist reply replies discussion disqus respond related recommended recommendations".split()
)
#: These only mark something outside an article, which may have a header of its own.
SITE_MARKS = frozenset("header masthead topbar site-header".split())
KEPT_TAGS = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre article main body html li dd dt td th tr".split())
_WORD = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _marked(element: Element, in_article: bool, holds_article: bool) -> bool:
    if not element.attributes:
        return False
    words = set(_WORD.findall(element.attribute("class", "id", "role")))
    if holds_article:
        return bool(words & LIST_MARKS)
    if words & MARKS or (not in_article and words & SITE_MARKS):
        return True
    return bool(_HIDDEN.search(element.attribute("style"))) or "hidden" in element.attribute("hidden")


#: A mark of an outline besides those of `pieces`.
INSTEAD = -2


def outline(html: str) -> list[tuple[int, str]]:
    """What may be main text: marks, each with the text behind it.

    Containers that go if they are template lie between their hash and END; BREAK ends a block, and what
    comes after INSTEAD counts if all before it is empty.
    """
    root = parse(html)
    elements = walk(root)
    hash_subtrees(elements)
    holds: set[int] = set()  # elements that contain an article or main
    inside: set[int] = set()  # elements within one
    for element in elements:
        parent = element.parent
        if parent is not None and (id(parent) in inside or parent.tag in ("article", "main")):
            inside.add(id(element))
    for element in reversed(elements):
        if element.parent is not None and (id(element) in holds or element.tag in ("article", "main")):
            holds.add(id(element.parent))
    dropped: set[int] = set()
    perhaps: set[int] = set()  # dropped if they are template
    for element in elements[1:]:
        within, tag = id(element) in inside, element.tag
        if id(element.parent) in dropped:
            dropped.add(id(element))
        elif tag in DROPPED or (tag == "header" and not within):
            if not (tag == "form" and id(element) in holds):
                dropped.add(id(element))
        elif (tag not in KEPT_TAGS or tag == "article") and _marked(element, within, id(element) in holds):
            dropped.add(id(element))
        elif tag in BLOCK and element.children and not (within and tag in TEXT_TAGS) and id(element) not in holds and tag not in KEPT_TAGS:
            perhaps.add(id(element))
    out: list[tuple[int, str]] = []
    for wanted in ("article", "main", ""):
        found = [e for e in elements if e.tag == wanted and id(e) not in dropped] if wanted else [root]
        outer = _outermost(elements, found) if len(found) > 1 else found
        marks = [m for e in _in_order(root, outer) for m in _marks(e, dropped, perhaps)]
        out += [(INSTEAD, ""), *marks] if out else marks
        if text_of(marks, None):
            break
    return out


def _marks(element: Element, dropped: set[int], perhaps: set[int]) -> list[tuple[int, str]]:
    out: list[tuple[int, str]] = []
    mark, texts = BREAK, []
    for piece in pieces(element, dropped, perhaps):
        if isinstance(piece, str):
            texts.append(piece)
        elif piece != BREAK or mark != BREAK or "".join(texts).strip():
            out.append((mark, "".join(texts)))
            mark, texts = piece, []
        else:
            texts = []
    return [*out, (mark, "".join(texts)), (BREAK, "")]


def text_of(marks: Iterable[tuple[int, str]], template: Container[int] | None) -> str:
    """The text of an outline without the containers that are template; without any if that is None."""
    out: list[str] = []
    run: list[str] = []
    depth = 0  # of containers in one that goes
    for mark, text in [*marks, (INSTEAD, "")]:
        if depth:
            depth += (mark > 0) - (mark == END)
            if not depth:
                run.append(text)
            continue
        if mark > 0 and (template is None or mark in template):
            depth = 1
            continue
        if block := " ".join(unescape("".join(run)).split()):
            out.append(block)
        run = [text]
        if mark == INSTEAD and out:
            break
    return "\n\n".join(out)


def main_text(html: str, template: Container[int] = frozenset()) -> str:
    return text_of(outline(html), template)


def _outermost(elements: list[Element], found: list[Element]) -> list[Element]:
    """Those of `found` that lie in no other; elements come with parents before children."""
    wanted, below = {id(e) for e in found}, set()
    for element in elements[1:]:
        if id(element.parent) in below or id(element.parent) in wanted:
            below.add(id(element))
    return [e for e in found if id(e) not in below]


def _in_order(root: Element, wanted: list[Element]) -> list[Element]:
    if len(wanted) < 2:
        return wanted
    ids, out, todo = {id(e) for e in wanted}, [], [root]
    while todo:
        element = todo.pop()
        if id(element) in ids:
            out.append(element)
        todo += [c for c in reversed(element.children) if not isinstance(c, str)]
    return out


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, page, digest of each different subtree; digest 0 stands for the page itself."""
    for batch in batches:
        hosts, pages, digests = [], [], []
        for host, page, html in zip(*(c.to_pylist() for c in batch.columns)):
            elements = walk(parse(html))
            hash_subtrees(elements)
            # articles and what holds them can't be deleted and need no count
            seen = {e.digest for e in elements[1:] if e.tag in BLOCK and e.tag not in KEPT_TAGS and e.children} | {0}
            hosts += [host] * len(seen)
            pages += [page] * len(seen)
            digests += seen
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(digests, pa.int64())],
            ["host", "page", "digest"],
        )


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [outline(html) for html in batch.column(4).to_pylist()]
        marks = pa.array([[m for m, _ in x] for x in lists], pa.list_(pa.int64()))
        texts = pa.array([[t for _, t in x] for x in lists], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], marks, texts], ["page_id", "url", "host", "page", "marks", "texts"])


def _sources(pages: DataFrame) -> DataFrame:
    """page_id, url, host, page (a hash of the html), html of every row."""
    html = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.xxhash64(html).alias("page"), html.alias("html"))


def subtrees(sources: DataFrame) -> DataFrame:
    """host, page, digest of the subtrees of every different page of a host."""
    found = sources.select("host", "page", "html").mapInArrow(_subtrees, "host string, page bigint, digest bigint")
    return found.distinct()


def templates(rows: DataFrame) -> DataFrame:
    """host, digest of the subtrees that belong to a host's template; rows are those of `subtrees`."""
    many = kept(rows.groupBy("host", "digest").agg(F.count("*").alias("pages")).filter(F.col("pages") >= LEAST_PAGES), "counts")
    whole = many.filter("digest = 0").select("host", F.col("pages").alias("all_pages"))
    least = F.least(F.lit(MANY), SHARE * F.col("all_pages"))
    return many.filter("digest <> 0").join(whole.hint("merge"), "host").filter(F.col("pages") >= least).select("host", "digest")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, marks, pieces, lists = (batch.column(i) for i in range(5))
            texts = [
                text_of(zip(*outlined), frozenset(digests or ()))
                for *outlined, digests in zip(marks.to_pylist(), pieces.to_pylist(), lists.to_pylist())
            ]
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [ids, urls, pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    sources = _sources(pages)
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = kept(subtrees(sources), "subtrees")
    # a page's list holds subtrees of its own only
    own = rows.join(templates(rows).hint("merge"), ["host", "digest"]).groupBy("host", "page").agg(F.collect_set("digest").alias("template"))
    outlines = sources.mapInArrow(
        _outlines, f"page_id {kind}, url string, host string, page bigint, marks array<bigint>, texts array<string>"
    )
    joined = outlines.join(kept(own, "templates").hint("merge"), ["host", "page"], "left")
    return joined.select("page_id", "url", "marks", "texts", "template").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint"
    )


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
