"""Reading a cleaned page line by line: its text lines, their tag paths and their normal forms.

A line of `content_text` is one block, numbered from 1. Lines that only open or close an element build the path.
"""

from __future__ import annotations

import html
import re

import xxhash

TAG = re.compile(r"<!--.*?-->|</?[A-Za-z!][^<>]*>")
DIGITS = re.compile(r"\d+")
WORD_CHAR = re.compile(r"[^\W_]")
LEAD = re.compile(r"<([A-Za-z][A-Za-z0-9]*)\b([^<>]*)>")
ONLY_OPEN = re.compile(r"\s*<([A-Za-z][A-Za-z0-9]*)\b([^<>]*)>\s*$")
ONLY_CLOSE = re.compile(r"\s*</([A-Za-z][A-Za-z0-9]*)\s*>\s*$")
ANCHOR = re.compile(r"<a\b([^<>]*)>(.*?)</a\s*>", re.I | re.S)
ATTR = re.compile(r"""\b(?:id|class|role)\s*=\s*["']?([^"'>]*)""", re.I)
HREF = re.compile(r"""\bhref\s*=\s*["']?([^"'\s>]*)""", re.I)
PUNCT = re.compile(r"[.,;!?。、]")
TITLES = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "dt"))  # elements whose end closes a phrase as a sign does
CELL = re.compile(r"<t[dh]\b", re.I)


def site_key(url: str | None) -> str:
    """A site's name without letter case and without a last slash; '' for NULL."""
    url = (url or "").lower()
    return url[:-1] if url.endswith("/") else url


def plain(line: str) -> str:
    """The line's text: each tag a space, character references resolved, white space collapsed."""
    if "<" in line:
        line = TAG.sub(" ", line)
    if "&" in line:
        line = html.unescape(line)
    return " ".join(line.split())


def normal(text: str) -> str:
    """The form in which two lines of a site are the same: lower case, each run of digits a 0."""
    return DIGITS.sub("0", text.lower())


def key(text: str) -> int:
    """A signed 64-bit hash of a string, the same in every process."""
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def text_lines(content: str | None) -> list[tuple[int, str]]:
    """(line number, plain text) of every text line."""
    out = []
    for no, line in enumerate((content or "").split("\n"), 1):
        text = plain(line)
        if text and WORD_CHAR.search(text):
            out.append((no, text))
    return out


class Line:
    """A text line with what its place in the tag tree says."""

    __slots__ = ("no", "text", "tag", "link", "away", "box", "boxes", "leaf", "spot", "signs")

    def __init__(self, no, text, tag, link, away, box, boxes, leaf, spot, signs):
        self.no, self.text, self.tag, self.link, self.away, self.box, self.boxes, self.leaf, self.spot, self.signs = no, text, tag, link, away, box, boxes, leaf, spot, signs


def host(url: str) -> str:
    """The host of an absolute URL in lower case, '' of any other."""
    head, sep, rest = url.partition("//")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower() if sep else ""


def read_page(content: str | None, site: str) -> list[Line]:
    """The text lines of a page. box: path of the enclosing elements; leaf: that path with the block's own tags;
    spot: which instance of an element, counted through the page; link: share of the text inside links;
    away: number of links to other hosts; signs: punctuation, as which the cells of a table's row and the end of a title count. Unclosed elements end with the element that encloses them."""
    own = host(site)
    stack: list[tuple[str, str]] = []
    path, spots, spot, out = "", [0], 0, []
    for no, raw in enumerate((content or "").split("\n"), 1):
        if raw.lstrip()[:1] == "<":
            if m := ONLY_CLOSE.match(raw):
                name = m[1].lower()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:], spots[i + 1:]
                        path = stack[-1][1] if stack else ""
                        break
                continue
            if (m := ONLY_OPEN.match(raw)) and m[1].lower() not in ("img", "br", "hr", "meta", "link", "input"):
                name = m[1].lower()
                mark = ".".join(x.strip().lower() for x in ATTR.findall(m[2]))
                path = f"{path}/{name}.{mark}" if mark else f"{path}/{name}"
                stack.append((name, path))
                spot += 1
                spots.append(spot)
                continue
        text = plain(raw)
        if not text or not WORD_CHAR.search(text):
            continue
        m = LEAD.match(raw.lstrip())
        tag = m[1].lower() if m else "#"
        link = away = 0
        if "<a" in raw or "<A" in raw:
            for attrs, inner in ANCHOR.findall(raw):
                link += len(plain(inner))
                h = HREF.search(attrs)
                there = host(h[1]) if h else ""
                away += bool(there and there != own)
        share = min(1.0, link / len(text))
        signs = len(PUNCT.findall(text)) + (len(CELL.findall(raw)) if tag == "tr" else tag in TITLES)
        out.append(Line(no, text, tag, share, away, path, len(stack), f"{path}/{tag}/a" if share > 0.9 else f"{path}/{tag}", spots[-1], signs))
    return out
