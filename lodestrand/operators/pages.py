"""Operators on the HTML of pages: decoding, patching, links and the cleaned page."""

from __future__ import annotations

import codecs
import re
from html import escape
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrand.config import CrawlConfig, java_regex, java_substitute
from lodestrand.schema import LINK
from lodestrand.session import ship

# Attributes that hold links, and elements without an end tag.
LINK_ATTRS = ("href", "src", "action", "background", "cite", "data", "longdesc", "usemap")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
META_CHARSET = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?([A-Za-z0-9_\-:.]+)""", re.I)
REFRESH = re.compile(r"url\s*=\s*['\"]?([^'\"]+)", re.I)


def patched(text: Column, config: CrawlConfig) -> Column:
    """The page after the crawl's regular expressions, one after the other."""
    for pattern, sub in config.patches:
        text = F.regexp_replace(text, java_regex(pattern), java_substitute(sub))
    return text


def patch_counts(text: Column, config: CrawlConfig) -> Column:
    """How many replacements each pattern makes, as an array in their order."""
    out = []
    for pattern, sub in config.patches:
        out.append(F.regexp_count(text, F.lit(java_regex(pattern))))
        text = F.regexp_replace(text, java_regex(pattern), java_substitute(sub))
    return F.array(*out).cast("array<int>")


def site_patched(text: Column, patterns: Column, subs: Column) -> Column:
    """The same with the options in columns: pairs as far as both lists reach, those with an empty side skipped."""
    some = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    n = F.least(F.size(some(patterns)), F.size(some(subs)))
    pairs = F.arrays_zip(F.slice(some(patterns), F.lit(1), n).alias("p"), F.slice(some(subs), F.lit(1), n).alias("s"))
    pairs = F.filter(pairs, lambda x: (F.coalesce(x["p"], F.lit("")) != "") & (F.coalesce(x["s"], F.lit("")) != ""))
    return F.aggregate(pairs, text, lambda acc, x: F.regexp_replace(acc, x["p"], F.when(x["s"] == "<EMPTYSTRING>", "").otherwise(x["s"])))


def decode_page(body: bytes | None, content_type: str | None) -> str | None:
    """Text of a response: by the header's charset, else the page's own, else UTF-8, else windows-1252; never an error."""
    if body is None:
        return None
    body = bytes(body)
    head = re.search(r"""charset\s*=\s*["']?([^\s;"']+)""", content_type or "", re.I)
    meta = META_CHARSET.search(body)
    for name in (head and head[1], meta and meta[1].decode("ascii", "ignore"), "utf-8"):
        if not name:
            continue
        try:
            codecs.lookup(name)
            return body.decode(name)
        except (LookupError, ValueError):
            continue
    return body.decode("windows-1252", "replace")


class _Page(HTMLParser):
    """Links in document order with their names, and the page written anew with absolute links."""

    def __init__(self, url: str) -> None:
        super().__init__(convert_charrefs=True)
        self.url, self.base = url, url
        self.links: list[list] = []  # dst, raw, fragment, attr, name
        self.out: list[str] = []
        self.open: list[str] = []
        self.names: list[tuple[int, list[str]]] = []  # links whose text is being read
        self.hidden = 0

    def absolute(self, raw: str) -> str:
        try:
            return urljoin(self.base, raw.strip())
        except ValueError:
            return raw.strip()

    def add(self, raw: str, attr: str, name: str | None) -> None:
        try:
            url, frag = urldefrag(self.absolute(raw))
        except ValueError:
            return
        self.links.append([url.removesuffix("/"), raw, frag or None, attr, name])

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == "base" and given.get("href"):
            self.base = urljoin(self.url, given["href"])
            return
        if tag == "meta" and (given.get("http-equiv") or "").lower() == "refresh":
            if m := REFRESH.search(given.get("content") or ""):
                self.links.append([self.absolute(m[1].strip()), m[1].strip(), None, "refresh", None])
        written = []
        for name, value in attrs:
            if name in LINK_ATTRS and value:
                if name == "href" and tag == "a":
                    self.names.append((len(self.links), []))
                self.add(value, name, (" ".join((given.get("alt") or "").split()) if name == "src" else None))
                absolute = self.absolute(value)
                if absolute.startswith(self.url):
                    absolute = absolute.removesuffix("/")
                value = absolute
            written.append(f' {name}="{escape(value)}"' if value is not None else f" {name}")
        if tag in ("script", "style"):
            self.hidden += 1
            return
        self.out.append(f"<{tag}{''.join(written)}>")
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("script", "style"):
            self.hidden -= 1
        elif tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
            return
        if tag == "a":
            self.close_name()
        if tag in self.open:
            while (top := self.open.pop()) != tag:
                self.out.append(f"</{top}>")
            self.out.append(f"</{tag}>")

    def close_name(self):
        if self.names:
            at, parts = self.names.pop()
            if at < len(self.links):
                self.links[at][4] = " ".join("".join(parts).split())

    def handle_data(self, data):
        if self.hidden:
            return
        for _, parts in self.names:
            parts.append(data)
        self.out.append(escape(data, quote=False))

    def finish(self):
        self.close()
        while self.names:
            self.close_name()
        self.out += [f"</{t}>" for t in reversed(self.open)]
        return self


def parse_page(url: str, html: str) -> _Page:
    page = _Page(url)
    page.feed(html)
    return page.finish()


def links_of(url: str, html: str | None) -> list[list]:
    """The links of a page in document order: [dst, raw, fragment, attr, name]. Absolute, without fragment and one last
    slash. name: an anchor's text, an image's alt text or '', NULL for other attributes. A refresh has its own attr."""
    return parse_page(url, html).links if html else []


def clean_html(url: str, html: str | None) -> str | None:
    """The page anew: every element closed, links absolute, no scripts, styles or comments. NULL for NULL."""
    return "".join(parse_page(url, html).out) if html is not None else None


def _rows(batches):
    for batch in batches:
        cols: list[list] = [[] for _ in range(8)]
        for url, seq, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for pos, (dst, raw, frag, attr, name) in enumerate(links_of(url, html)):
                for c, v in zip(cols, (url, seq, pos, dst, raw, frag, attr, name), strict=True):
                    c.append(v)
        types = (pa.string(), pa.int64(), pa.int32(), *[pa.string()] * 5)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["src", "seq", "pos", "dst", "raw", "fragment", "attr", "name"])


def extract_links(pages: DataFrame) -> DataFrame:
    """LINK rows of pages (url, seq, html). Pages without html or url have none."""
    ship(pages.sparkSession)
    return pages.filter("url IS NOT NULL AND html IS NOT NULL").select("url", F.col("seq").cast("bigint"), "html").mapInArrow(_rows, LINK)


def _cleaned(batches):
    for batch in batches:
        url, html = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([clean_html(u, h) for u, h in zip(url, html, strict=True)], pa.string())], ["url", "content_text"])


def clean_pages(pages: DataFrame) -> DataFrame:
    """(url, content_text) of pages (url, html)."""
    ship(pages.sparkSession)
    return pages.filter("url IS NOT NULL").select("url", "html").mapInArrow(_cleaned, "url string, content_text string")


def _decoded(batches):
    for batch in batches:
        body, ct = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([decode_page(b, c) for b, c in zip(body, ct, strict=True)], pa.string())], ["url", "html"])


def decode_pages(pages: DataFrame) -> DataFrame:
    """(url, html) of responses (url, body, content_type)."""
    ship(pages.sparkSession)
    return pages.select("url", "body", "content_type").mapInArrow(_decoded, "url string, html string")


ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)(?:</a\s*>|<li\b|<p\b|</li|</p|</div)"""
META_REFRESH = r"""(?is)<meta\b[^>]*http-equiv\s*=\s*["']?refresh["']?[^>]*content\s*=\s*["'][^"']*?url\s*=\s*([^"'>\s]+)"""


def anchors(html: Column) -> Column:
    """The raw href of each anchor by a regular expression alone, without a Python worker: for counts and screening."""
    return F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1))


def title(html: Column) -> Column:
    """A page's title as it is written, white space squashed; '' for none."""
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title", 1), r"\s+", " "))


def meta_refresh(html: Column) -> Column:
    """The target of a page's refresh in its own spelling, NULL for none."""
    hit = F.regexp_extract(html, META_REFRESH, 1)
    return F.when(hit != "", hit)
