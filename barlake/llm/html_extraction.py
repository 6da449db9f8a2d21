"""HTML extraction: the main text of pages, with site templates removed (operator 6).

Each page is read once into elements. Every container's subtree gets a hash of its tags and text;
Spark counts per host on how many different pages each hash occurs. Subtrees on ``LEAST_PAGES`` pages or
more are deleted, whatever the size of the host, as are menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments by tag, role or class. Pages never meet by host: the counts are
joined with single subtrees, and a page with the list of its own templates, which is no longer than the page. What remains of the article (of
``main`` or the body where a page has none) is cut into blocks, in page order.

Headings, paragraphs, quotes and the like inside the article are content however often they recur: a
passage that many articles of a host quote is no template. Copies of one page count once.

A null page has no text, a null address is a host of its own. White space inside a block
becomes one space, a line break counts as white space, blocks are joined by a newline.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.text import column

# A subtree is a template of a host if it is on so many of its different pages.
LEAST_PAGES = 3

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>"
    r"|<[a-zA-Z/!?][^<>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

# Fixed values of HTML: elements without content, and elements whose content is no markup.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr script style template noscript".split()
)
# An opening tag closes an open element of these names, unless one of the barriers lies between.
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
BARRIERS = {"ul", "ol", "dl", "table", "select", "article", "main", "body", "div", "section"}

# Elements that are never part of a main text.
DROPPED = set(
    "nav footer aside form script style title textarea noscript iframe template head button select svg canvas object "
    "dialog menu xmp noembed noframes audio video map".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
# Parts of class names and ids that mark such elements.
DROPPED_NAMES = set(
    "ad ads advert advertisement advertising adsense sponsor sponsored promo banner cookie cookies consent gdpr notice "
    "alert sidebar comment comments respond replies disqus menu nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead share sharing social related newsletter subscribe subscription popup modal toolbar".split()
)
MAIN = {"article", "main"}
# Elements that hold an article's own text.
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption article main body html".split())

NAME_PARTS = re.compile(r"[A-Za-z][a-z]*|[0-9]+")


class Page:
    """Elements of a page in document order, and its text pieces."""

    def __init__(self, source: str):
        self.tags: list[str] = ["html"]
        self.parents: list[int] = [-1]
        self.marks: list[bool] = [False]
        # Pieces: element and text; a block element's start and end are pieces without text.
        self.pieces: list[tuple[int, str | None]] = []
        self.open_tags: Counter[str] = Counter()
        self._read(source)

    def _close(self, stack: list[int], depth: int) -> None:
        for element in stack[depth:]:
            self.open_tags[self.tags[element]] -= 1
        del stack[depth:]

    def _open(self, tag: str, attributes: str, stack: list[int]) -> None:
        if tag not in INLINE:
            closes = CLOSED_BY.get(tag)
            if closes:
                for depth in range(len(stack) - 1, 0, -1):
                    name = self.tags[stack[depth]]
                    if name in closes:
                        self._close(stack, depth)
                        break
                    if name in BARRIERS:
                        break
            # A block ends an open paragraph.
            for depth in range(len(stack) - 1, 0, -1):
                name = self.tags[stack[depth]]
                if name == "p":
                    self._close(stack, depth)
                    break
                if name not in INLINE:
                    break
        self.tags.append(tag)
        self.open_tags[tag] += 1
        self.parents.append(stack[-1])
        self.marks.append(bool(attributes) and _marked(attributes, tag))
        stack.append(len(self.tags) - 1)
        if tag not in INLINE:
            self.pieces.append((stack[-1], None))

    def _read(self, source: str) -> None:
        stack, at, lower = [0], 0, None
        while True:
            match = TAG.search(source, at)
            end = match.start() if match else len(source)
            if end > at:
                self.pieces.append((stack[-1], source[at:end]))
            if not match:
                break
            at = match.end()
            tag = match[2] or match[5]
            if not tag:
                continue
            tag = tag.lower()
            if match[1] or match[4]:
                if self.open_tags[tag]:
                    depth = len(stack) - 1
                    while self.tags[stack[depth]] != tag:
                        depth -= 1
                    self._close(stack, depth)
                if tag not in INLINE:
                    self.pieces.append((stack[-1], None))
                continue
            attributes = match[3] if match[2] else match[6]
            if tag in VOID:
                self.pieces.append((stack[-1], " " if tag in INLINE else None))
                continue
            self._open(tag, attributes, stack)
            if tag in RAW:
                lower = lower if lower is not None else source.lower()
                end = lower.find(f"</{tag}", at) if len(lower) == len(source) else -1
                if end < 0:
                    found = re.compile(rf"</{tag}", re.I).search(source, at)
                    end = found.start() if found else len(source)
                if end > at:
                    self.pieces.append((stack[-1], source[at:end]))
                at = end

    def protected(self) -> list[bool]:
        """Elements that hold the article, and text elements inside it."""
        out = [False] * len(self.tags)
        inside = [False] * len(self.tags)
        for e in range(1, len(self.tags)):
            inside[e] = inside[self.parents[e]] or (self.tags[e] in MAIN and not self.marks[e])
            if self.tags[e] in MAIN and not self.marks[e]:
                up = e
                while up >= 0 and not out[up]:
                    out[up] = True
                    up = self.parents[up]
            elif inside[e] and self.tags[e] in PROSE:
                out[e] = True
        out[0] = True
        return out

    def hashes(self) -> list[int]:
        """A hash of every element's subtree: its tags and its text without white space around pieces."""
        parts: list[list[str]] = [[] for _ in self.tags]
        for element, text in self.pieces:
            if text and (text := " ".join(text.split())):
                parts[element].append(text)
        out = [0] * len(self.tags)
        below: list[list[str]] = [[] for _ in self.tags]
        for e in range(len(self.tags) - 1, -1, -1):
            content = "\0".join([self.tags[e], *reversed(below[e]), *parts[e]])
            out[e] = xxhash.xxh3_64_intdigest(content)
            if e:
                below[self.parents[e]].append(str(out[e]))
        return out

    def candidates(self) -> list[int]:
        """Hashes of the containers that could be templates, as signed whole numbers."""
        keep, hashes = self.protected(), self.hashes()
        found = {
            hashes[e] for e in range(1, len(self.tags)) if not keep[e] and self.tags[e] not in INLINE and not self._dropped(e)
        }
        return sorted(h - (1 << 64) if h >> 63 else h for h in found)

    def _dropped(self, e: int) -> bool:
        return self.marks[e] or self.tags[e] in DROPPED

    def text(self, templates: set[int]) -> str:
        """The main text without elements whose hash is a template."""
        keep = self.protected()
        hashes = self.hashes() if templates else None
        n = len(self.tags)
        gone, main = [False] * n, [False] * n
        wanted = next((t for t in ("article", "main") if any(self.tags[e] == t and not self.marks[e] for e in range(n))), None)
        for e in range(n):
            up = self.parents[e]
            holds_main = keep[e] and self.tags[e] not in PROSE
            gone[e] = (up >= 0 and gone[up]) or (self._dropped(e) and not holds_main) or (
                self.tags[e] == "header" and not (up >= 0 and main[up]) and not holds_main
            )
            if hashes is not None and not keep[e] and self.tags[e] not in INLINE:
                h = hashes[e]
                gone[e] = gone[e] or (h - (1 << 64) if h >> 63 else h) in templates
            main[e] = wanted is None or (up >= 0 and main[up]) or self.tags[e] == wanted
        blocks, current = [], []
        for element, text in self.pieces:
            if text is None:
                if current:
                    blocks.append("".join(current))
                    current = []
            elif main[element] and not gone[element]:
                current.append(text)
        if current:
            blocks.append("".join(current))
        clean = (" ".join(html.unescape(b).split()) for b in blocks)
        return "\n".join(b for b in clean if b)


def _marked(attributes: str, tag: str) -> bool:
    """Whether class, id or role say that an element is no main text."""
    for match in ATTRIBUTE.finditer(attributes):
        name = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name in ("class", "id") and tag not in ("body", "html"):
            if any(p.lower() in DROPPED_NAMES for p in NAME_PARTS.findall(value)):
                return True
    return False


def host(url: Column) -> Column:
    address = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(address)


def _page(html_col: str) -> list[Column]:
    """A 128-bit key of a page's source; copies are one page."""
    return [
        F.xxhash64(column(html_col)).alias("page1"),
        F.xxhash64(F.lit("other"), column(html_col)).alias("page2"),
    ]


PAGE_KEYS = ["place", "page1", "page2"]


def _subtrees(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``place`` (a hash of the host), page and ``hashes`` of the subtrees of every page row."""
    rows = pages.select(
        F.xxhash64(host(column(url_col))).alias("place"), *_page(html_col), column(html_col).alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(h).candidates() if h else [] for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in PAGE_KEYS), pa.array(found, pa.list_(pa.int64()))], [*PAGE_KEYS, "hashes"]
            )

    return rows.mapInArrow(run, "place long, page1 long, page2 long, hashes array<long>")


def _counted(subtrees: DataFrame, least: int) -> DataFrame:
    """``place`` and ``hash`` of the subtrees that are on ``least`` different pages of a host."""
    seen = subtrees.select("place", "page1", F.explode("hashes").alias("hash")).distinct()
    return seen.groupBy("place", "hash").agg(F.count("*").alias("n_pages")).filter(F.col("n_pages") >= least)


def site_templates(
    pages: DataFrame, least: int = LEAST_PAGES, url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``host``, ``hash`` and ``n_pages`` of the subtrees that recur on pages of their host."""
    hosts = pages.select(host(column(url_col)).alias("host")).distinct()
    counted = _counted(_subtrees(pages, url_col, html_col), least)
    named = hosts.withColumn("place", F.xxhash64("host"))
    return counted.join(named, "place").select("host", "hash", "n_pages")


def page_templates(
    pages: DataFrame, least: int = LEAST_PAGES, url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per host and page with any, the hashes of its own subtrees that are templates."""
    subtrees = _subtrees(pages, url_col, html_col)
    single = subtrees.dropDuplicates(PAGE_KEYS).select(*PAGE_KEYS, F.explode("hashes").alias("hash"))
    common = _counted(subtrees, least).select("place", "hash")
    return single.join(common, ["place", "hash"]).groupBy(*PAGE_KEYS).agg(F.collect_set("hash").alias("templates"))


def main_text(
    pages: DataFrame,
    least: int = LEAST_PAGES,
    key_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Per page row: ``key``, ``url`` and ``text``."""
    templates = page_templates(pages, least, url_col, html_col)
    rows = pages.select(
        column(key_col).alias("key"),
        column(url_col).alias("url"),
        column(html_col).alias("html"),
        F.xxhash64(host(column(url_col))).alias("place"),
        *_page(html_col),
    )
    joined = rows.join(templates, PAGE_KEYS, "left").select("key", "url", "html", "templates")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch["html"].to_pylist(), batch["templates"].to_pylist(), strict=True)
            texts = [Page(source).text(set(mine or ())) if source else "" for source, mine in rows]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["url"], pa.array(texts, pa.string())], ["key", "url", "text"]
            )

    return joined.mapInArrow(run, f"key {kinds['key']}, url {kinds['url']}, text string")
