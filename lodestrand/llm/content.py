"""Problem 1: the lines of a page that are its own content.

Method: tag-path ratios. For each root-to-leaf tag path of a site the length and the punctuation of its text are summed
over all pages, every different line once, bare links without any, and divided by the number of nodes: so a path of
recurrent or linked text has a low ratio, a path of prose a high one. A node's score fuses its path's ratio with its own
and is smoothed along the page within its element; nodes below LOW are no content. Two kinds of nodes within a good path
carry no weight: lines that the site repeats on many of its pages (equal pages count as one there, so that copies of a
page do not make its content furniture), and lines framed (by their first or last two words) as furniture is. The frames
are learned from the ratios: those that stand in low paths or recurrent lines of several sites, and in good paths hardly
ever begin or end longer text, nor mostly what is all an element says.

Two passes over the pages: the first yields the site's statistics (aggregated before they are shuffled), the second
joins them to its pages. What is joined to a page is bounded: lines and paths that stand on a fixed share of the
site's pages, hence at most (lines of a page / share) of them, whatever the size of the site.
"""

from __future__ import annotations

from math import sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrand.llm.pages import PUNCT, TITLES, WORD_CHAR, Line, key, normal, read_page
from lodestrand.session import materialise, ship

STATS = "site string, path bigint, line bigint, n bigint, len bigint, signs bigint, boxed tinyint, first bigint, last bigint, few bigint"
LINE, PATH = 1, 2
LINE_PAGES, LINE_SHARE = 3, 0.12  # a line is recurrent on so many pages and so large a share of its site's pages
MANY_PAGES, MANY_SHARE = 20, 0.02  # or on so many pages and so large a share
PATH_SHARE = 0.02  # paths on fewer of a site's pages are judged by the page alone
HOT_SHARE, HOT_PAGES = 0.01, 1000  # a site with so large a share and so many pages is spread over several tasks
LOW = 7.0  # a score below it is no content
FRAMED = 90  # characters of the longest line that is taken for furniture by its frame
# A frame is furniture's if it is seen so often there, on so large a share of all pages (which bounds the number of
# frames) and on so many sites; furniture has such a share of its lines, good paths' long lines at most so many, and of
# its short lines in good paths at most such a share stands in a marked element of FEW lines or less.
FRAME_LEAST, FRAME_PAGES, FRAME_SITES, FRAME_SHARE, FRAME_LONG, FRAME_FEW, FEW = 3, 1e-4, 3, 0.1, 0.02, 0.5, 2
SECTIONS = frozenset(("main", "article", "section", "aside", "nav", "header", "footer"))  # elements that are marked by their name
TEXT_TAGS = frozenset(("p", "li", "div", "span", "#"))  # tags of lines that frames are told of
MEMO = 200_000


def ratio(n: float, length: float, signs: float) -> float:
    """The fused ratio of a path: text and punctuation for each of its nodes."""
    return sqrt(length / n * (1 + signs / n)) if n else 0.0


def is_bare(x: Line) -> bool:
    """A line that is nothing but links."""
    return x.leaf.endswith("/a")


def is_marked(x: Line) -> bool:
    """A line directly in an inner element that has a class, an id or a name that says what it is."""
    own = x.box.rsplit("/", 1)[-1]
    return x.boxes > 2 and ("." in own or own in SECTIONS)


def line_key(x: Line, norm: str) -> int:
    """What is counted as the same line: a bare link is another than the same words as text."""
    return key("\x01" + norm) if is_bare(x) else key(norm)


def frames_of(x: Line, norm: str) -> tuple[int, int]:
    """The frames of a line, its first and its last two words, hashed; 0 where it has none. A first word with a colon is
    a frame by itself."""
    words = norm.split()
    if len(words) < 3 or x.tag not in TEXT_TAGS or is_bare(x):
        return 0, 0
    first = words[0] if words[0][-1] == ":" and len(words[0]) > 2 else " ".join(words[:2])
    last = "\x02" + " ".join(words[-2:])
    return tuple(key(f) if any(len(w) > 1 and WORD_CHAR.search(w) and not w[0].isdigit() for w in f.split()) else 0 for f in (first, last))


def _count(batches):
    """The first pass: the lines of a batch's different pages (site, content_text, rows) by path, summed within the batch.
    The row of path and line 0 is the site's: n pages, len rows."""
    memo: dict[tuple[str, str], tuple] = {}
    for batch in batches:
        acc: dict[tuple[str, int, int], list[int]] = {}
        for site, content, rows in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            whole = acc.setdefault((site, 0, 0), [0, 0, 0, 0, 0, 0, 0])
            whole[0] += 1
            whole[1] += rows
            seen, lines, held = set(), read_page(content, site), {}
            for x in lines:
                if x.tag not in TITLES and not is_bare(x):
                    held[x.spot] = held.get(x.spot, 0) + 1
            for x in lines:
                known = memo.get((x.leaf, x.text))
                if known is None:
                    if len(memo) >= MEMO:
                        memo.clear()
                    norm = normal(x.text)
                    known = memo[x.leaf, x.text] = (key(x.leaf), line_key(x, norm), *((0, 0) if is_bare(x) else (len(x.text), x.signs)), int(x.boxes > 2), *frames_of(x, norm))
                k = (site, known[0], known[1])
                if k in seen:
                    continue
                seen.add(k)
                if (a := acc.get(k)) is None:
                    a = acc[k] = [0, *known[2:], 0]
                a[0] += 1
                a[-1] += held.get(x.spot, 0) <= FEW and is_marked(x)
        keys, sums = (list(zip(*acc, strict=True)), list(zip(*acc.values(), strict=True))) if acc else ([()] * 3, [()] * 7)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int64()), pa.array(keys[2], pa.int64()), *(pa.array(s, t) for s, t in zip(sums, types, strict=True))],
            ["site", "path", "line", "n", "len", "signs", "boxed", "first", "last", "few"],
        )


class Notes:
    """What is known of a site: its recurrent lines and the ratios of its paths; and the frames of furniture everywhere."""

    __slots__ = ("lines", "paths", "frames")

    def __init__(self, entries=(), frames: frozenset[int] = frozenset()) -> None:
        self.lines = {e["key"]: e["value"] for e in entries if e["kind"] == LINE}
        self.paths = {e["key"]: e["value"] for e in entries if e["kind"] == PATH}
        self.frames = frames


def scores(lines: list[Line], notes: Notes) -> list[float]:
    """The smoothed and fused tag-path ratio of each text line of a page."""
    n = len(lines)
    norms = [normal(x.text) for x in lines]
    shares = [notes.lines.get(line_key(x, t), 0.0) for x, t in zip(lines, norms, strict=True)]
    bare = [is_bare(x) for x in lines]
    framed = [len(x.text) <= FRAMED and any(f in notes.frames for f in frames_of(x, t)) for x, t in zip(lines, norms, strict=True)]
    own: dict[str, list[int]] = {}
    for x, b in zip(lines, bare, strict=True):
        a = own.setdefault(x.leaf, [0, 0, 0])
        a[0] += 1
        if not b:
            a[1] += len(x.text)
            a[2] += x.signs
    paths = {leaf: notes.paths.get(key(leaf), ratio(*a)) for leaf, a in own.items()}
    # Fused: a node with more text than its path has on average is lifted towards its own ratio.
    fused = []
    for x, share, b, f in zip(lines, shares, bare, framed, strict=True):
        path = paths[x.leaf]
        fused.append(0.0 if share or f else path if b else sqrt(path * max(path, ratio(1, len(x.text), x.signs))))
    # Lists of bare links: their run, or all of one inner element, counts as text where it leads away from the site.
    lists: dict[object, list[int]] = {}
    run = 0
    for i, x in enumerate(lines):
        if bare[i]:
            lists.setdefault(x.spot if x.boxes > 2 else (x.spot, run), []).append(i)
        else:
            run += 1
    for at in lists.values():
        out = sum(lines[i].away for i in at)
        if len(at) >= 4 and out >= 3 and out * 8 >= len(at):
            for i in at:
                fused[i] = 0.0 if shares[i] else max(LOW, fused[i])
    # Smooth along the page, within one element, over the nodes that carry weight.
    some = [i for i in range(n) if fused[i]]
    smooth = [0.0] * n
    for k, i in enumerate(some):
        near = [(fused[j], 2 if j == i else 1) for j in some[max(0, k - 2) : k + 3] if lines[j].spot == lines[i].spot]
        smooth[i] = max(fused[i], sum(v * w for v, w in near) / sum(w for _, w in near))
    # An inner element is as strong as its strongest node; where a page has many copies on its site, none of its lines
    # has a weight of its own, so an inner element with the page's heading is taken at the full ratios.
    headed = {x.spot for x, b in zip(lines, bare, strict=True) if x.tag == "h1" and x.boxes > 2 and not b}
    best: dict[int, float] = {}
    for x, f, no in zip(lines, fused, framed, strict=True):
        if x.spot in headed and not f and not no:
            f = paths[x.leaf]
        best[x.spot] = max(best.get(x.spot, 0.0), f)
    out = []
    for i, x in enumerate(lines):
        strong = best[x.spot]
        if framed[i]:
            out.append(0.0)
        elif shares[i]:
            # Copies of a page repeat its lines too: text of a strong element stays unless most pages have it.
            prose = len(x.text) >= 60 and PUNCT.search(x.text[-1:]) and shares[i] < 0.35
            inner = not bare[i] and x.boxes > 2 and strong >= 2 * LOW and shares[i] < 0.6
            out.append(strong if prose or inner else 0.0)
        elif bare[i]:
            out.append(smooth[i] if fused[i] >= LOW else 0.0)
        else:
            out.append(max(smooth[i], strong) if x.boxes > 2 else smooth[i])
    return out


def own_content(lines: list[Line], notes: Notes) -> list[bool]:
    """For each text line of a page whether it belongs to the page's own content."""
    return [s >= LOW for s in scores(lines, notes)]


def site_notes(pages: DataFrame) -> tuple[DataFrame, frozenset[int], dict[str, int]]:
    """(site, entries) for each site, the frames of furniture (see the module's docstring), and over how many tasks each
    hot site is to be spread. pages: (item_id, site, content_text). Hot sites are those with HOT_SHARE of all pages, so
    few at any size; the frames are bounded by FRAME_PAGES: at most (lines of a page * 2 / FRAME_PAGES) of them."""
    # One vote for pages that are equal as lines are: but for case and digits.
    alike = F.md5(F.regexp_replace(F.lower("content_text"), r"\d+", "0"))
    votes = pages.groupBy("site", alike.alias("page")).agg(F.min("content_text").alias("content_text"), F.count("*").alias("rows")).select("site", "content_text", "rows")
    sums = votes.mapInArrow(_count, STATS).groupBy("site", "path", "line").agg(F.sum("n").alias("n"), F.sum("len").alias("sum"), F.sum("few").alias("few"), *(F.max(c).alias(c) for c in ("len", "signs", "boxed", "first", "last")))
    sums = materialise(sums, "site-sums")  # read more than once below: written, so that the pages are counted once
    totals = materialise(sums.filter("path = 0 AND line = 0").select("site", F.col("n").alias("pages"), F.col("sum").alias("rows")), "site-totals")
    whole = totals.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages")).first()
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = totals.filter((F.col("rows") >= HOT_SHARE * whole["rows"]) & (F.col("rows") >= HOT_PAGES)).collect()  # at most 1 / HOT_SHARE rows
    spread = {r["site"]: min(tasks, -(-2 * tasks * r["rows"] // whole["rows"])) for r in hot}
    lines = sums.filter("NOT (path = 0 AND line = 0)")
    n, total = F.col("n"), F.col("pages")
    often = (n >= LINE_PAGES) & (n >= LINE_SHARE * total) | (n >= MANY_PAGES) & (n >= MANY_SHARE * total)
    repeated = lines.groupBy("site", "line").agg(F.sum("n").alias("n")).filter(n >= LINE_PAGES).join(totals, "site").filter(often)
    repeated = materialise(repeated.select("site", "line", (n / total).alias("share")), "site-lines")
    paths = lines.groupBy("site", "path").agg(F.sum("n").alias("n"), F.sum("len").alias("len"), F.sum("signs").alias("signs"))
    paths = materialise(paths.select("site", "path", "n", F.sqrt(F.col("len") / n * (1 + F.col("signs") / n)).alias("ratio")), "site-paths")
    entry = lambda kind, k, value: F.struct(F.lit(kind).cast("tinyint").alias("kind"), F.col(k).alias("key"), F.col(value).alias("value")).alias("e")
    kept = paths.join(totals, "site").filter(n >= PATH_SHARE * total).select("site", entry(PATH, "path", "ratio"))
    notes = repeated.select("site", entry(LINE, "line", "share")).unionByName(kept).groupBy("site").agg(F.collect_list("e").alias("entries"))
    return notes, _frames(lines, repeated, paths, whole["pages"]), spread


def _frames(lines: DataFrame, repeated: DataFrame, paths: DataFrame, pages: int) -> frozenset[int]:
    """The frames of furniture, hashed. Good paths are asked only for frames that are furniture's often enough."""
    told = lines.filter("first <> 0 OR last <> 0").join(paths.select("site", "path", "ratio"), ["site", "path"]).join(repeated.select("site", "line", "share"), ["site", "line"], "left")
    told = told.select("site", "n", "few", "len", F.explode(F.array("first", "last")).alias("frame"), (F.col("share").isNotNull() | (F.col("ratio") < LOW) & (F.col("boxed") == 1)).alias("low")).filter("frame <> 0")
    low = told.filter("low").groupBy("frame", "site").agg(F.sum("n").alias("n")).groupBy("frame").agg(F.sum("n").alias("low"), F.count("*").alias("sites"))
    low = low.filter((F.col("low") >= max(FRAME_LEAST, FRAME_PAGES * pages)) & (F.col("sites") >= FRAME_SITES))
    tells = lambda name, c, fits: F.sum(F.when(fits, F.col(c))).alias(name)
    brief = F.col("len") <= FRAMED
    good = told.filter("NOT low").join(low.select("frame"), "frame", "left_semi").groupBy("frame").agg(tells("short", "n", brief), tells("long", "n", ~brief), tells("few", "few", brief))
    short, long, few = (F.coalesce(c, F.lit(0)) for c in ("short", "long", "few"))
    every = F.col("low") + short
    found = low.join(good, "frame", "left").filter((long <= FRAME_LONG * every) & (F.col("low") >= FRAME_SHARE * every) & (few <= FRAME_FEW * short))
    return frozenset(r["frame"] for r in found.select("frame").collect())  # bounded by FRAME_PAGES


def read_pages(pages: DataFrame, f, schema: str, learned: tuple | None = None) -> DataFrame:
    """The second pass: f gets, task by task, what `each_page` gives of every page, and yields batches of the schema. Hot
    sites are salted: their pages go to several tasks by a hash of the id, and their one row of notes to each of these.
    learned: what site_notes gave of these pages or of more, if they were counted before."""
    notes, frames, spread = learned or site_notes(pages)
    many = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in spread.items() for x in kv)), F.col("site")), F.lit(1)) if spread else F.lit(1)
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("item_id"), many).cast("int"))
    copied = notes.withColumn("salt", F.explode(F.sequence(F.lit(0), many - 1)))
    joined = salted.join(copied, ["site", "salt"], "left").select("item_id", "site", "content_text", "entries")
    return joined.mapInArrow(lambda batches: f(each_page(batches, frames)), schema)


def each_page(batches, frames: frozenset[int]):
    """Of joined batches (item_id, site, content_text, entries): batch, item, lines, what to keep."""
    held: dict[str, Notes] = {}
    for batch in batches:
        ids, sites, texts = (batch.column(i).to_pylist() for i in range(3))
        for i, (item, name, content) in enumerate(zip(ids, sites, texts, strict=True)):
            if (notes := held.get(name)) is None:
                if len(held) >= 64:
                    held.clear()
                notes = held[name] = Notes(batch.column(3)[i].as_py() or (), frames)
            lines = read_page(content, name)
            yield batch, item, lines, own_content(lines, notes)


def _select(pages):
    last, ids, nos = None, [], []
    out = lambda: pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int64())], ["item_id", "line_no"])
    for batch, item, lines, keep in pages:
        if batch is not last and ids:
            yield out()
            ids, nos = [], []
        last = batch
        for x, k in zip(lines, keep, strict=True):
            if k:
                ids.append(item)
                nos.append(x.no)
    if ids:
        yield out()


def pages_of(items: DataFrame, item: str = "item_id", site: str = "site_url", text: str = "content_text") -> DataFrame:
    """The three columns the passes need, of items with text; the site as `site_key` names it."""
    ship(items.sparkSession)
    name = F.coalesce(F.regexp_replace(F.lower(F.col(site).cast("string")), "/$", ""), F.lit(""))
    return items.select(F.col(item).cast("bigint").alias("item_id"), name.alias("site"), F.col(text).cast("string").alias("content_text")).filter("content_text IS NOT NULL")


def content_lines(items: DataFrame, *, item: str = "item_id", site: str = "site_url", text: str = "content_text") -> DataFrame:
    """(item_id, line_no) of the text lines that are a page's own content.

    NULL or empty text gives no row; a NULL site is a site of its own; repeated ids are judged each by themselves;
    other columns are ignored. An empty table gives an empty result.
    """
    return read_pages(pages_of(items, item, site, text), _select, "item_id bigint, line_no bigint")
