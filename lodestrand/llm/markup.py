"""Problem 5: HTML, Markdown, wiki and LaTeX markup in texts; its languages, and the text in clean form.

Method: minimum-cut labelling. The blocks (lines) of a text are nodes. For each language a classifier gives every block
a cost of calling it markup and of calling it plain; these become the capacities to the two terminals. Neighbouring
blocks, and blocks held together by one element (an opening and its closing tag, a fence, an environment, a table),
are joined by smoothness edges. The minimum cut separates the blocks of the language from the plain ones.
A language occurs in a text if the cut puts a block with a construct of its own there to the language; and only the
language's blocks are cleaned.

The classifier is naive Bayes over the kinds of constructs and signs, fitted on a sample of at most FIT_DOCS documents:
the cost of a kind is the log odds of meeting it in a block of a text that is full of the language's constructs against
one of a text that is not. A kind that stands alone in many texts (a sign of ordinary writing) thus tells little, and its
neighbours decide; one that mostly stands among others decides alone.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import deque
from itertools import accumulate, groupby
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrand.session import ship

# The names of elements that count as HTML.
TAGS = "p|h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tr|th|td|caption|pre|code|b|i|u|s|em|strong|small|sub|sup|a|span|div|br|img|hr|blockquote|font|center|html|head|body|title|script|style|section|article|nav|header|footer|main|form|input|button|label|iframe|video|audio|source|figure|figcaption"
# Elements that stand beside those in a page; they do not tell that a text is HTML.
PAGE_TAGS = "meta|link|base|aside|noscript|address|time|abbr|cite|q|del|ins|kbd|var|samp|mark|big|tt|strike|tfoot|col|colgroup|select|option|textarea|fieldset|legend|details|summary|picture|object|param|embed|map|area"
# Constructs that only a language's markup has, and signs that become markup beside them. Bare signs of ordinary
# writing (prices, comparisons, footnote numbers, file names, bullets) are in neither list of any language.
OWN_KINDS = {
    "html": {"tag": rf"</?(?:{TAGS})(?:\s[^<>]*)?/?>", "comment": r"<!--", "doctype": r"<!doctype\b", "entity": r"&(?:[a-z]{2,8}[0-9]{0,2}|#\d{1,7}|#x[0-9a-f]{1,6});"},
    "markdown": {
        "heading": r"^#{1,6} \S", "rule": r"^={3,}\s*$", "strong": r"\*\*[^*\s](?:[^*\n]*[^*\s])?\*\*", "strike": r"~~[^~\n]+~~",
        "link": r"!?\[(?:[^\[\]\n]|\[[^\[\]\n]*\])*\]\([^()\s]*(?: \"[^\"\n]*\")?\)", "fence": r"^```", "code": r"(?<!`)`[^`\n]+`(?!`)", "table": r"^\|?(?:\s*:?-{3,}:?\s*\|){1,}",
    },
    "wiki": {
        "heading": r"^(?P<level>={2,6})[^=\n]+(?P=level)\s*$", "link": r"\[\[[^\[\]\n]+\]\]", "bold": r"'''[^'\n]+'''", "italic": r"(?<![`'\w])''[^'`\n]+''(?!')", "template": r"\{\{[^{}\n]+\}\}",
        "table": r"^\{\|.*$|^\|\}\s*$|^\|-\s*$", "weblink": r"\[https?://\S+ [^\]\n]+\]", "note": r"<ref\b|</ref>|<nowiki>", "redirect": r"^#REDIRECT\b",
    },
    "latex": {
        "environment": r"\\(?:begin|end)\{", "section": r"\\(?:sub)*section\b",
        "command": r"\\(?:chapter|paragraph|label|caption|footnote|text[a-z]{2}|emph|cite[a-z]*|ref|item|frac|sqrt|sum|int|left|right|alpha|beta|usepackage|documentclass|maketitle|hline|S)(?![A-Za-z])|\\[A-Za-z]+\{",
        "maths": r"\$[^$\n]*[\\^_{][^$\n]*\$|\\\[|\\\(", "quotes": r"``[^`'\n]+''",
    },
}
SIGN_KINDS = {
    "html": {"less": "<", "more": ">", "and": "&"},
    "markdown": {"quote": "^> ", "bullet": "^[-*+] ", "number": r"^\d+\. ", "pipe": r"^\|", "line": r"^-{3,}\s*$", "star": r"\*[^*\s][^*\n]*\*", "under": r"_[^_\n]+_"},
    "wiki": {"item": "^[*#:;]+", "cell": "^[|!]", "quotes": "''"},
    "latex": {"back": r"\\", "brace": "[{}]", "tilde": "~", "hat": r"\^", "low": "_", "and": "&", "dollar": r"\$"},
}


def _any(kinds: dict[str, str], flags: int = 0) -> re.Pattern:
    return re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in kinds.items()), re.M | flags)


OWN = {language: _any(kinds, re.I if language == "html" else 0) for language, kinds in OWN_KINDS.items()}
SIGNS = {language: _any(kinds) for language, kinds in SIGN_KINDS.items()}
# What a text must hold for any of a language's constructs, and a block for any of its signs, anywhere or first in it.
# They follow from the patterns; where none is there, the slower patterns need not be tried.
OWN_HINTS = {
    "html": ("<", "&"),
    "markdown": ("#", "===", "**", "~~", "](", "`", "---"),
    "wiki": ("==", "[[", "''", "{{", "{|", "|}", "|-", "[http", "<ref", "</ref>", "<nowiki>", "#REDIRECT"),
    "latex": ("\\", "$", "``"),
}
SIGN_HINTS = {"html": ("<", ">", "&"), "markdown": ("*", "_"), "wiki": ("''",), "latex": ("\\", "{", "}", "~", "^", "_", "&", "$")}
SIGN_FIRST = {"markdown": re.compile(r"[-*+>|\d]"), "wiki": re.compile(r"[*#:;|!]")}
# Pairs that hold the blocks between them together.
HOLD = {
    "html": (re.compile(r"<(ul|ol|table|pre|dl|blockquote|div|p|h[1-6]|i|b)\b[^<>]*>", re.I), re.compile(r"</(ul|ol|table|pre|dl|blockquote|div|p|h[1-6]|i|b)\s*>", re.I)),
    "markdown": (re.compile(r"^(```)"), re.compile(r"^(```)")),
    "wiki": (re.compile(r"^(\{\|)"), re.compile(r"^(\|\})")),
    "latex": (re.compile(r"\\begin\{(\w+)\*?\}"), re.compile(r"\\end\{(\w+)\*?\}")),
}
# Constructs that may go over several lines, which they hold together.
SPAN = {
    "html": re.compile(r"<!--.*?-->|<(script|style|pre)\b.*?</\1\s*>|</?[a-z][^<>]*>", re.S | re.I),
    "markdown": re.compile(r"(?m)^[^\n]*\S[^\n]*\n={3,}[ \t]*$"),
    "wiki": re.compile(r"<ref\b[^<>]*>.*?</ref>", re.S),
    "latex": re.compile(r"\\\[.*?\\\]|\\[A-Za-z]+\{[^{}]*\}", re.S),
}
# Costs: what a block's plainness weighs, and the smoothness edges. What an element holds is no evidence of plain writing.
PLAIN, NEAR, HELD = 1.0, 0.5, 3.0
# The classifier: documents of its sample, blocks that either side must have for a fit, the costs before any is seen
# (as if on PRIOR_BLOCKS blocks), and how many constructs a text is full of the language with.
FIT_DOCS, FIT_BLOCKS, PRIOR_BLOCKS, OWN_COST, SIGN_COST, FULL = 20_000, 200, 50.0, 6.0, 0.7, 3
MOST_COST = 8.0
Costs = dict[str, dict[str, float]]
ORDER = ("html", "markdown", "wiki", "latex")


def min_cut(n: int, source: list[int], sink: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """The nodes on the source's side of a minimum cut (the smallest such side). Shortest augmenting paths."""
    s, t = n, n + 1
    cap: list[dict[int, int]] = [{} for _ in range(n + 2)]

    def add(u, v, c, back):
        cap[u][v] = cap[u].get(v, 0) + c
        cap[v][u] = cap[v].get(u, 0) + back

    for i in range(n):
        direct = min(source[i], sink[i])  # this much flows straight through
        if source[i] > direct:
            add(s, i, source[i] - direct, 0)
        if sink[i] > direct:
            add(i, t, sink[i] - direct, 0)
    for (u, v), c in edges.items():
        add(u, v, c, c)
    while True:
        came = {s: s}
        queue = deque([s])
        while queue and t not in came:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > 0 and v not in came:
                    came[v] = u
                    queue.append(v)
        if t not in came:
            return [i in came for i in range(n)]
        push, v = None, t
        while v != s:
            push = cap[came[v]][v] if push is None else min(push, cap[came[v]][v])
            v = came[v]
        v = t
        while v != s:
            cap[came[v]][v] -= push
            cap[v][came[v]] += push
            v = came[v]


def chain_cut(source: list[int], sink: list[int], near: list[int]) -> list[bool]:
    """The same for nodes in a row, near[i] joining i and i + 1: by dynamic programming, in one pass there and back."""
    n, back = len(source), []
    # (cost, nodes on the source's side) of the best labelling so far that ends plain, and that ends on the source's side.
    plain, inside = (0, 0), (0, 0)
    for i in range(n):
        c = near[i - 1] if i else 0
        to_plain, to_inside = (inside[0] + c, inside[1]) < plain, not (plain[0] + c, plain[1]) < inside
        p = (inside[0] + c, inside[1]) if to_plain else plain
        q = inside if to_inside else (plain[0] + c, plain[1])
        back.append((to_plain, to_inside))
        plain, inside = (p[0] + source[i], p[1]), (q[0] + sink[i], q[1] + 1)
    out, side = [False] * n, inside < plain
    for i in range(n - 1, -1, -1):
        out[i] = side
        side = back[i][side]
    return out


def holds(blocks: list[str], language: str) -> list[tuple[int, int]]:
    """Pairs of neighbouring blocks within one element of the language."""
    opening, closing = HOLD[language]
    stack: list[tuple[str, int]] = []
    out = []
    for i, b in enumerate(blocks):
        if language == "markdown":
            if opening.match(b):
                if stack:
                    at = stack.pop()[1]
                    out += [(j, j + 1) for j in range(at, i)]
                else:
                    stack.append(("", i))
            continue
        events = sorted([(m.start(), 0, m[1].lower()) for m in opening.finditer(b)] + [(m.start(), 1, m[1].lower()) for m in closing.finditer(b)])
        for _, closes, name in events:
            want = "{|" if name == "|}" else name
            if not closes:
                stack.append((name, i))
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == want:
                    out += [(j, j + 1) for j in range(stack[k][1], i)]
                    del stack[k:]
                    break
    return out


def spans(blocks: list[str], language: str) -> list[tuple[int, int]]:
    """Pairs of neighbouring blocks within one construct that goes over several lines."""
    if language not in SPAN or len(blocks) < 2:
        return []
    starts = list(accumulate((len(b) + 1 for b in blocks), initial=0))
    out = []
    for m in SPAN[language].finditer("\n".join(blocks)):
        if "\n" in m[0]:
            out += [(j, j + 1) for j in range(bisect_right(starts, m.start()) - 1, bisect_right(starts, m.end() - 1) - 1)]
    return out


PRIOR: Costs = {language: {**dict.fromkeys(OWN_KINDS[language], OWN_COST), **{f"sign {k}": SIGN_COST for k in SIGN_KINDS[language]}} for language in ORDER}


def hinted(text: str, language: str) -> bool:
    """Whether a text may hold a construct of the language at all."""
    return any(h in text for h in OWN_HINTS[language])


def signs(block: str, language: str) -> set[str]:
    first = SIGN_FIRST.get(language)
    if not (first and first.match(block)) and not any(h in block for h in SIGN_HINTS[language]):
        return set()
    return {f"sign {m.lastgroup}" for m in SIGNS[language].finditer(block)}


def label(blocks: list[str], language: str, own: list[list[str]], costs: Costs = PRIOR) -> list[bool]:
    """Which blocks the cut puts to the language. own: the kinds of the language's constructs in each block."""
    n, cost = len(blocks), costs[language]
    source, sink = [0.0] * n, [0.0] * n
    for i, (kinds, b) in enumerate(zip(own, blocks, strict=True)):
        tells = [cost[k] for k in (*kinds, *signs(b, language))]
        source[i] = sum(c for c in tells if c > 0)
        sink[i] = (PLAIN if b.strip() else 0.0) - sum(c for c in tells if c < 0)
    near = [NEAR] * (n - 1)
    for i, j in {*holds(blocks, language), *spans(blocks, language)}:
        near[i] += HELD
        sink[i] = sink[j] = 0.0
    return chain_cut(source, sink, near)


def constructs(blocks: list[str], text: str, language: str) -> list[list[str]]:
    """The kinds of the language's constructs in each block; those of lines are matched in the whole text."""
    out: list[list[str]] = [[] for _ in blocks]
    if not hinted(text, language):
        return out
    starts, at = [], 0
    for b in blocks:
        starts.append(at)
        at += len(b) + 1
    i = 0
    for m in OWN[language].finditer(text):
        if m.lastgroup == "rule" and (m.start() == 0 or not _line_before(text, m.start()).strip()):
            continue  # a rule under nothing is no heading
        while i + 1 < len(starts) and starts[i + 1] <= m.start():
            i += 1
        out[i].append(m.lastgroup)
    return out


def _line_before(text: str, at: int) -> str:
    end = at - 1
    return text[text.rfind("\n", 0, max(0, end)) + 1 : max(0, end)]


def labels(text: str | None, costs: Costs = PRIOR) -> dict[str, list[bool]]:
    """For each language that occurs in the text, which of its blocks are the language's."""
    if not text:
        return {}
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    found = {}
    blocks = None
    for language in ORDER:
        if not hinted(text, language):
            continue
        blocks = blocks or text.split("\n")
        own = constructs(blocks, text, language)
        if not any(own):
            continue
        side = label(blocks, language, own, costs)
        if any(a and b for a, b in zip(side, own, strict=True)):
            found[language] = side
    return found


def _tell(batches):
    """(language, full, kind, blocks): how many blocks of texts that are full of a language, and of the others, hold a
    kind; the kind '' stands for all blocks."""
    for batch in batches:
        acc: dict[tuple[str, bool, str], int] = {}
        for text in batch.column(0).to_pylist():
            text = text.replace("\r\n", "\n").replace("\r", "\n")
            blocks = text.split("\n")
            for language in ORDER:
                own = constructs(blocks, text, language)
                full = sum(map(len, own)) >= FULL
                k = (language, full, "")
                acc[k] = acc.get(k, 0) + sum(1 for b in blocks if b.strip())
                for kinds, b in zip(own, blocks, strict=True):
                    for kind in {*kinds, *signs(b, language)}:
                        k = (language, full, kind)
                        acc[k] = acc.get(k, 0) + 1
        keys = list(acc)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([k[2] for k in keys], pa.string()), pa.array(list(acc.values()), pa.int64())],
            ["language", "full", "kind", "blocks"],
        )


def fit(texts: DataFrame, most: int = FIT_DOCS) -> Costs:
    """The classifier's costs, from the texts (doc, text) of the `most` documents with the least hashes of their ids; of
    these one row for each kind comes to the driver. A language of which either side has fewer than FIT_BLOCKS blocks
    keeps the costs of PRIOR."""
    ids = texts.select("doc").filter("doc IS NOT NULL").orderBy(F.xxhash64("doc"), "doc").limit(most)
    sample = texts.filter("text IS NOT NULL").join(F.broadcast(ids.distinct()), "doc", "left_semi").select("text")  # at most `most` ids
    seen: dict[tuple[str, bool, str], int] = {}
    for r in sample.mapInArrow(_tell, "language string, full boolean, kind string, blocks bigint").groupBy("language", "full", "kind").agg(F.sum("blocks").alias("blocks")).collect():
        seen[r["language"], r["full"], r["kind"]] = r["blocks"]
    out = {}
    for language, prior in PRIOR.items():
        yes, no = seen.get((language, True, ""), 0), seen.get((language, False, ""), 0)
        if min(yes, no) < FIT_BLOCKS:
            out[language] = prior
            continue
        out[language] = {}
        for kind, before in prior.items():
            with_, without = seen.get((language, True, kind), 0), seen.get((language, False, kind), 0)
            # Smoothed by the prior's odds, as if seen on PRIOR_BLOCKS blocks of a full text.
            odds = log((with_ + PRIOR_BLOCKS) / (yes + PRIOR_BLOCKS)) - log((without + PRIOR_BLOCKS * exp(-before) * no / yes) / (no + PRIOR_BLOCKS))
            out[language][kind] = max(-MOST_COST, min(MOST_COST, odds))
    return out


# ---------------------------------------------------------------- clean text

_BLOCK_TAG = re.compile(r"</?(p|div|ul|ol|table|tbody|thead|tr|dl|dt|dd|h[1-6]|blockquote|pre|section|article|br|hr|li)\b[^<>]*>", re.I)


def _html(t: str) -> str:
    code: list[str] = []

    def keep(m):
        code.append(html.unescape(re.sub(r"<[^<>]*>", "", m[1])))
        return f"\n\x00{len(code) - 1}\x00\n"

    t = re.sub(r"<!--.*?(?:-->|$)", "", t, flags=re.S)
    t = re.sub(r"<(script|style)\b.*?</\1\s*>", "", t, flags=re.S | re.I)
    t = re.sub(r"<pre\b[^<>]*>(.*?)(?:</pre\s*>|$)", keep, t, flags=re.S | re.I)
    t = re.sub(r"</t[hd]>\s*<t[hd]\b[^<>]*>", "\t", t, flags=re.I)
    t = re.sub(r"<h([1-6])\b[^<>]*>", lambda m: "\n\n" + "#" * int(m[1]) + " ", t, flags=re.I)
    t = re.sub(r"</h[1-6]\s*>", "\n\n", t, flags=re.I)
    t = re.sub(r"<li\b[^<>]*>", "\n- ", t, flags=re.I)
    t = _BLOCK_TAG.sub("\n", t)
    t = re.sub(rf"</?(?:{TAGS}|{PAGE_TAGS})(?:\s[^<>]*)?/?>|<!doctype\b[^<>]*>", "", t, flags=re.I)
    t = html.unescape(t).replace("\xa0", " ")
    return re.sub("\x00(\\d+)\x00", lambda m: "\n".join("    " + x for x in code[int(m[1])].split("\n")), t)


def _markdown(t: str) -> str:
    out, fenced = [], False
    for b in t.split("\n"):
        if b.startswith("```"):
            fenced = not fenced
            continue
        if fenced:
            out.append("    " + b)
            continue
        if re.fullmatch(r"={3,}\s*", b) and out and out[-1].strip():
            out[-1] = "# " + out[-1].lstrip("# ")
            continue
        if re.fullmatch(r"\|?(?:\s*:?-{3,}:?\s*\|)+(?:\s*:?-{3,}:?)?\s*", b):
            continue
        if b.startswith("|") and b.rstrip().endswith("|") and len(b) > 1:
            b = "\t".join(x.strip() for x in b.strip().strip("|").split("|"))
        b = re.sub(r"^[*+] ", "- ", b)
        b = re.sub(r"^> ?", "", b)
        b = re.sub(r"!?\[((?:[^\[\]\n]|\[[^\[\]\n]*\])*)\]\([^()\s]*(?: \"[^\"\n]*\")?\)", r"\1", b)
        b = re.sub(r"\*\*([^*\n]+)\*\*|~~([^~\n]+)~~|(?<!`)`([^`\n]+)`(?!`)", lambda m: m[1] or m[2] or m[3], b)
        out.append(b)
    return "\n".join(out)


def _wiki(t: str) -> str:
    out, table, row = [], False, []
    for b in t.split("\n"):
        if b.startswith("{|"):
            table, row = True, []
            continue
        if table and (b.startswith("|}") or b.startswith("|-")):
            if row:
                out.append("\t".join(row))
            row, table = [], not b.startswith("|}")
            continue
        if table and b[:1] in "|!":
            row += [x.strip() for x in re.split(r"\|\||!!", b[1:])]
            continue
        if m := re.fullmatch(r"(={1,6})([^=]+)\1\s*", b):
            out.append("#" * max(1, len(m[1]) - 1) + " " + m[2].strip())
            continue
        out.append(re.sub(r"^[*#]+\s*(?=\S)", "- ", b) if re.match(r"^[*#]+\s*[\['\w]", b) and not re.match(r"^#{1,6} ", b) else b)
    if row:
        out.append("\t".join(row))
    t = "\n".join(out)
    t = re.sub(r"\[\[(?:File|Image|Datei|Fichier|Archivo):[^\[\]\n|]*(?:\|[^\[\]\n|]*)*?\|?([^\[\]\n|]*)\]\]", r"\1", t)
    t = re.sub(r"\[\[(?:[^\[\]\n|]*\|)?([^\[\]\n|]*)\]\]", r"\1", t)
    t = re.sub(r"\{\{[^{}\n]*\}\}", "", t)
    t = re.sub(r"<ref\b[^<>]*?(?:/>|>.*?</ref>)", "", t)
    t = re.sub(r"\[https?://\S+ ([^\]\n]+)\]", r"\1", t)
    return re.sub(r"'''([^'\n]+)'''|(?<![`'\w])''([^'`\n]+)''(?!')", lambda m: m[1] or m[2], t)


def _latex(t: str) -> str:
    maths: list[str] = []

    def keep(m):
        maths.append(m[0])
        return f"\x00{len(maths) - 1}\x00"

    t = re.sub(r"\\begin\{(equation|align|displaymath|gather)\*?\}.*?\\end\{\1\*?\}|\$[^$\n]*[\\^_{][^$\n]*\$|\\\[.*?\\\]", keep, t, flags=re.S)
    t = re.sub(r"\\(chapter|section|subsection|subsubsection|paragraph)\*?\{([^{}]*)\}", lambda m: "#" * (1 + ("chapter", "section", "subsection", "subsubsection", "paragraph").index(m[1])) + " " + m[2] + "\n", t)
    t = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?\n?", "", t)
    t = re.sub(r"\\item\s*(?:\[([^\]]*)\])?\s*", lambda m: "- " + (m[1] + " " if m[1] else ""), t)
    t = re.sub(r"~?\\(?:cite[a-z]*|label|ref|index)\{[^{}]*\}", "", t)
    t = re.sub(r"\\S(?![A-Za-z])\s*", "§", t)
    for _ in range(3):
        t = re.sub(r"\\(?:text[a-z]{2}|emph|textbf|caption|footnote|underline)\{([^{}]*)\}", r"\1", t)
    t = re.sub(r"``([^`'\n]+)''", "\u201c\\1\u201d", t).replace("~", " ")
    t = re.sub(r"\\\\\s*", "\n", t)
    t = re.sub(r"\\([#$%&_{}])", r"\1", t)
    return re.sub("\x00(\\d+)\x00", lambda m: maths[int(m[1])], t)


CLEAN = {"html": _html, "markdown": _markdown, "wiki": _wiki, "latex": _latex}


def clean(text: str | None, found: dict[str, list[bool]] | None = None, costs: Costs = PRIOR) -> str | None:
    """The text without the markup of the languages it holds, of which only the languages' own blocks are changed. Headings become '# ' lines, lists '- ' lines, code is set in
    by four spaces, table cells are parted by tabs, formulas stay as written. Text without markup stays as it is."""
    if not text:
        return text
    found = labels(text, costs) if found is None else found
    if not found:
        return text
    t = text.replace("\r\n", "\n").replace("\r", "\n")
    for language in ("latex", "wiki", "markdown", "html"):
        if language in found:
            blocks = t.split("\n")
            # One language cleaned before shifts the blocks, so the next is labelled anew.
            side = found[language] if len(found) == 1 else label(blocks, language, constructs(blocks, t, language), costs)
            runs = ((ours, "".join(b + "\n" for _, b in run)) for ours, run in groupby(zip(side, blocks, strict=True), key=lambda x: x[0]))
            t = "".join(CLEAN[language](run) if ours else run for ours, run in runs).removesuffix("\n")
    return re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", t)).strip("\n")


def _find(costs: Costs):
    def find(batches):
        for batch in batches:
            ids, kinds = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for language in labels(text, costs):
                    ids.append(doc)
                    kinds.append(language)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string())], ["doc_id", "markup"])

    return find


def _clean(costs: Costs):
    def clean_batches(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [labels(t, costs) for t in texts]
            out = [clean(t, f, costs) for t, f in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([",".join(f) for f in found], pa.string()), pa.array(out, pa.string())], ["doc_id", "markup", "text"])

    return clean_batches


def _source(documents: DataFrame, doc: str, text: str) -> DataFrame:
    ship(documents.sparkSession)
    return documents.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))


def markup_languages(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", costs: Costs | None = None) -> DataFrame:
    """(doc_id, markup): one row for each language whose markup a document's text holds.

    NULL, empty and plain texts give no row; repeated ids are judged each by themselves; other columns are ignored.
    costs: of the classifier, by default fitted on a sample of these documents. One pass over whole texts, no shuffle.
    """
    src = _source(documents, doc, text)
    return src.filter("text IS NOT NULL").mapInArrow(_find(costs or fit(src)), "doc_id bigint, markup string")


def clean_texts(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", costs: Costs | None = None) -> DataFrame:
    """(doc_id, markup, text): every row, its languages joined by commas ('' for none) and its clean text (NULL stays NULL)."""
    src = _source(documents, doc, text)
    return src.mapInArrow(_clean(costs or fit(src)), "doc_id bigint, markup string, text string")
