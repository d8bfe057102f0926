import re
import time
from html import unescape

import pytest
from conftest import SF_DIR

from ledgerline.llm import extract
from ledgerline.llm.html import hash_subtrees, parse, walk


def plain(html):
    """The paragraphs and headings of the pages' own form."""
    found = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)
    parts = re.split(r"</?(?:p|h1)>", found[1].replace("<br>", " ")) if found else []
    texts = (" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts)
    return "\n\n".join(t for t in texts if t)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    htmls = {r.page_id: (r.url, r.html) for r in pages.collect()}
    got = extract.extracted(pages).collect()
    assert len(got) == len(htmls)
    for r in got:
        url, html = htmls[r.page_id]
        assert (r.url, r.text, r.n_chars) == (url, plain(html), len(plain(html)))


CASES = {
    "": "",
    "no markup &lt;b&gt;": "no markup <b>",
    "<p>a<p>b<ul><li>1<li>2</ul>tail": "a\n\nb\n\n1\n\n2\n\ntail",
    "<article><header><h1>T</h1></header><p>x&nbsp; y<br>z</p><footer>f</footer></article><aside>s</aside>": "T\n\nx y z",
    "<body class='has-sidebar'><header>site</header><div id=main-menu>m</div><p>text": "text",
    "<main><p>m</p><section class='comments'><article>reader</article></section></main>": "m",
    "<article><p>a</p><div class='advert'>buy</div><form><input>go</form><p>b</article>": "a\n\nb",
    "<article>one</article><article class=comment>no</article><article>two</article>": "one\n\ntwo",
    "<p>kept<script>if (a<b) { '</p>' }</script><style>p{}</style> on</p>": "kept on",
    "<!-- <p>no</p> --><p title='a>b'>yes</p><p hidden>no</p><p style='display: none'>no": "yes",
    "<table><tr><td>1<td>2<tr><td>3</table>": "1\n\n2\n\n3",
    "<p>cut &am": "cut &am",
    "<p>open <b": "open <b",
    "</div></p><p>x</b></i>y": "xy",
}


def test_small_pages():
    for html, text in CASES.items():
        assert extract.main_text(html) == text, html
    extract.main_text("<" * 100_000)
    extract.main_text("<p>" * 20_000 + "deep")
    extract.main_text("<div>" * 20_000 + "deep")


def test_site_template_is_removed(spark):
    bar = "<div><p>Every page says this</p></div>"
    pages = [(i, f"http://site/{i}", f"<body>{bar}<p>text {i}</p></body>") for i in range(8)]
    pages += [(100 + i, f"http://other/{i}", f"<body>{bar if i == 0 else ''}<p>page {i}</p></body>") for i in range(8)]
    quote = "<p>A passage that half the articles quote</p>"
    pages += [(200 + i, "http://quotes/", f"<article><p>own {i}</p>{quote if i % 2 else ''}</article>") for i in range(8)]
    pages += [(300, None, "<p>no url</p>"), (301, "not a url", None), (300, None, "<p>no url</p>")]
    df = spark.createDataFrame([(*p, "h", "t") for p in pages], "page_id bigint, url string, html string, host string, template string")
    got = {r.page_id: r.text for r in extract.extracted(df).collect()}
    assert all(got[i] == f"text {i}" for i in range(8))
    assert got[100] == "Every page says this\n\npage 0"
    assert got[201] == "own 1\n\nA passage that half the articles quote"
    assert got[300] == "no url" and got[301] == ""
    assert extract.extracted(df).count() == len(pages)
    assert extract.extracted(df.filter("false")).count() == 0


def test_counts_are_those_of_a_plain_count(spark):
    pages = {(extract_host(p.url), p.html) for p in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    want, sizes = {}, {}
    for host, html in pages:
        elements = walk(parse(html))
        hash_subtrees(elements)
        sizes[host] = sizes.get(host, 0) + 1
        for d in {e.digest for e in elements[1:] if e.tag in extract.BLOCK and e.tag not in extract.KEPT_TAGS and e.children}:
            want[host, d] = want.get((host, d), 0) + 1
    expected = {k for k, n in want.items() if n >= max(extract.LEAST_PAGES, min(extract.MANY, extract.SHARE * sizes[k[0]]))}
    rows = extract.subtrees(extract._sources(spark.read.parquet(f"{SF_DIR}/pages.parquet")))
    assert {tuple(r) for r in extract.templates(rows).collect()} == expected


def extract_host(url):
    return re.match(r"\w+://([^/?#]*)", url)[1].lower()


def test_the_template_of_a_section_is_removed(spark):
    """A bar on a third of a host's pages goes; the text of a page with many copies stays."""
    bar = "<div><p>Every page of this section says this</p></div>"
    pages = [(i, "http://site/", f"<body>{bar if i % 3 == 0 else ''}<div><p>text {i}</p></div></body>") for i in range(90)]
    pages += [(100 + i, "http://site/", "<body><div><p>copied</p></div></body>") for i in range(60)]
    got = {r.page_id: r.text for r in extract.extracted(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(90)} | {100 + i: "copied" for i in range(60)}


@pytest.mark.parametrize(
    "html",
    ["<div>" * 100_000, "<article>a</article>" * 100_000, "<p><table>" + "<b>" * 50_000 + "<div>" * 50_000, "<li><ul>" + "<b><li>" * 50_000],
)
def test_time_is_linear(html):
    start = time.monotonic()
    extract.main_text(html)
    assert time.monotonic() - start < 5


def test_outlines_hold_what_any_template_leaves():
    """Nested containers, text that meets over one that goes, and articles that are empty without it."""
    html = "<article><div><section>s</section>d</div></article><main>m</main>x &am<div>one</div>p; y"
    elements = walk(parse(html))
    hash_subtrees(elements)
    digest = {e.children[-1]: e.digest for e in elements if e.children and isinstance(e.children[-1], str)}
    assert extract.main_text(html) == "s\n\nd"
    assert extract.main_text(html, {digest["s"]}) == "d"
    assert extract.main_text(html, {digest["d"]}) == "m"
    bare = html.removeprefix("<article><div><section>s</section>d</div></article><main>m</main>")
    assert extract.main_text(bare) == "x &am\n\none\n\np; y"
    assert extract.main_text(bare, {digest["one"]}) == "x & y"


def test_no_html_is_shuffled(spark):
    """What a page says outside its text stays where it was read, and joins have one plan at every size."""
    noise = "".join(f"<script>var x{i} = {i * i}</script>" for i in range(3000))
    pages = [(i, "http://site/", f"<body>{noise}<article><p>text {i}</p></article></body>") for i in range(20)]
    found = extract.extracted(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sum(len(t) for _, t in extract.outline(pages[0][2])) < 100
    assert {r.page_id: r.text for r in found.collect()} == {i: f"text {i}" for i in range(20)}
