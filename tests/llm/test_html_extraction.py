import html
import re

import pytest
from pyspark.sql import functions as F

from barlake.llm.html_extraction import Page, main_text, site_templates
from barlake.llm.queries import registered

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="ad">Buy &amp; sell</div><div id="cookie-notice">Cookies</div>
<article><h1>Head &amp; more</h1><p><b>First  text<br>goes on<p>Second &lt;b&gt; &eacute;&#x41; <i>it</i>alic</p>
<div class="share">Share</div><ul><li>one<li>two</ul><form>Mail <input name="x"></form><!-- no > -->
<blockquote>quoted</blockquote><div id="comments"><article class="comment">I say</article></div></article>
<aside>More</aside><footer>&copy;</footer></body></html>"""


def test_article():
    wanted = ["Head & more", "First text goes on", "Second <b> éA italic", "one", "two", "quoted"]
    assert Page(PAGE).text(set()).split("\n") == wanted


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("", ""),
        ("plain & text < 3", "plain & text < 3"),
        ("<p>cut off &am", "cut off &am"),
        ("<p>cut <a href='x", "cut"),
        ("<p title='a>b'>x</p><p title=\"open>y</p>", "x\ny"),
        ("<main><p>in</p></main><p>out", "in"),
        ("<p>a<script>if (a<b) '</p>'</script>b", "ab"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<article>x</article><article>y</article>", "x\ny"),
        ("<!-- <p>no</p> --><p>yes", "yes"),
        ("<p>never closed comment <!-- rest", "never closed comment"),
        ("<style>only style", ""),
        ("<DIV>A<SCRIPT>x</ScRiPt>B</DIV>", "AB"),
    ],
)
def test_pieces(source, wanted):
    assert Page(source).text(set()) == wanted


def test_long_pages_take_time_in_proportion():
    assert Page("<p title='" * 3000 + "<b>" * 2000 + "x" * 100).text(set()) is not None
    assert len(Page("<p>word word</p>" * 50_000).text(set()).split("\n")) == 50_000


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_templates_of_a_host_go(spark):
    box = "<div><p>Read our paper</p></div>"
    rows = [(i, f"https://h.example/{i}", f"{box}<div><p>page {i}</p></div>") for i in range(6)]
    rows += [(10, "https://other.example/", f"{box}<p>alone</p>"), (11, None, None), (12, "not an address", "")]
    rows += [(20 + i, "http://copies.example/", f"{box}<p>same</p>") for i in range(5)]
    rows += [(30 + i, "http://art.example/", f"<article><p>quoted by all</p><p>{i}</p>{box}</article>") for i in range(4)]
    frame = pages(spark, rows).withColumns({"text": F.lit("x"), "host": F.lit(1), "key": F.lit(2)})
    got = {r["key"]: r["text"] for r in main_text(frame).collect()}
    assert len(got) == len(rows)
    assert [got[i] for i in range(6)] == [f"page {i}" for i in range(6)]
    assert got[10] == "Read our paper\nalone"
    assert (got[11], got[12]) == ("", "")
    assert got[20] == "Read our paper\nsame"
    # Prose inside an article stays, other containers that recur in it go.
    assert got[31] == "quoted by all\n1"
    assert {r["host"] for r in site_templates(frame).collect()} == {"h.example", "art.example"}
    assert main_text(frame.limit(0)).collect() == []


def test_boxes_of_sections_go_however_many_other_sections_there_are(spark):
    rows = []
    for section in range(10):
        # The box of a section is on 5 % (a half of the section) to 10 % of the host's pages.
        for i in range(12):
            box = f"<div><ul><li>Links of {section}</li></ul></div>" if section % 2 or i % 2 else ""
            url = f"https://h.example/s{section}/{'deep/' if i > 8 else ''}{i}.html?x=/y/"
            rows.append((len(rows), url, f"{box}<div><p>page {section} {i}</p></div>"))
    got = {r["key"]: r["text"] for r in main_text(pages(spark, rows)).collect()}
    assert got == {k: f"page {k // 12} {k % 12}" for k in range(120)}
    few = {r["key"]: r["text"] for r in main_text(pages(spark, rows[:12])).collect()}
    assert few == {k: got[k] for k in range(12)}


def article(source):
    """The given pages' text, by their own simple form: headings and paragraphs of one article."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", inner)
    clean = (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    wanted = {r["page_id"]: (r["url"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = registered()["op6_html_extraction"](spark, sf).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        url, source = wanted[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (url, article(source), len(article(source)))


def test_boxes_without_a_telling_tag_go_by_their_count(spark):
    """The given pages, each with a box of its host inside the article that no tag or class gives away."""
    stored = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    hosts = {r["page_id"]: r["url"].split("/")[2] for r in stored}
    rows = [
        (r["page_id"], r["url"], r["html"].replace("<article>", f"<article><div><span>Box of {hosts[r['page_id']]}</span></div>"))
        for r in stored
    ]
    different = {}
    for key, _, source in rows:
        different.setdefault(hosts[key], set()).add(source)
    frame = pages(spark, rows).repartition(5)
    got = {r["key"]: r["text"] for r in main_text(frame).collect()}
    plain = {r["key"]: r["text"] for r in main_text(frame, least=10**9).collect()}
    removed = 0
    for (key, _, _), original in zip(rows, stored, strict=True):
        box, text = f"Box of {hosts[key]}", article(original["html"])
        assert plain[key] == f"{box}\n{text}"
        recurs = len(different[hosts[key]]) >= 3
        assert got[key] == (text if recurs else f"{box}\n{text}")
        removed += recurs
    assert removed > len(rows) / 2
    counts = {}
    for host, sources in different.items():
        for source in sources:
            for found in set(Page(source).candidates()):
                counts[host, found] = counts.get((host, found), 0) + 1
    wanted = {(h, found, n) for (h, found), n in counts.items() if n >= 3}
    assert {tuple(r) for r in site_templates(frame).collect()} == wanted


def test_end_tags_without_a_start_cost_nothing():
    assert Page("<b>" * 30_000 + "x" + "</i>" * 30_000).text(set()) == "x"
