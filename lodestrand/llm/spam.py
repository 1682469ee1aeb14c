"""Problem 6: pages made of repeated keywords, bare link lists or product tags rather than sentences.

Method: the mean pointwise mutual information of neighbouring words, from document counts of words and word pairs over
the page content of the whole corpus. It is taken relative to the most it can be for words so frequent, ln(df(ab) /
min(df(a), df(b))), which makes languages and sizes of a corpus comparable, and a page's own occurrence does not count,
so that its repeated collocations do not vouch for themselves. Incoherent word salad and stuffed keywords have a mean
far below that of sentences; a page is flagged if its mean and a standard error are below LOW_PMI (fewer pairs tell
less), or if it repeats most of its pairs and is short of function words, as sentences are not. Backlinks from many other hosts raise the line by SUSPECT.

Every page is scored. As many function words as sentences have lower the line by CLEAR: edited and rare sentences reach
LOW_PMI, and pairs of words that no other page has, of which the corpus tells nothing, ln(UNSEEN). Pages are counted in blocks of a bounded number of words: a block sends each of its different words
and pairs once to be counted over the corpus, gets their document counts back, and scores its pages with them. So what
is shuffled and what a task holds does not grow with how often a block repeats a pair. Pages of residue (problem 3) are
no spam; only pages that the scores find are asked for it. Equal pages of a site count once; the verdict goes to all of them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrand.llm.content import pages_of, read_pages, site_notes
from lodestrand.llm.pages import key
from lodestrand.llm.residue import residue
from lodestrand.session import materialise

WORD = re.compile(r"[^\W\d_]+")
# Frequent function words of the corpus' languages.
FUNCTION = frozenset(
    """the a an and or but of to in into on at by from for with without is are was were be been has have had that this which who while as it its if so than then there
    der die das den dem des ein eine einen einer und oder aber ist sind war wird werden wurde für von vom bei zu zum zur mit ohne nicht auf aus seit als dass wenn weil um bis hat haben im am in an
    le la les un une des du de et ou mais est sont était sera été pour par pas ne dans sur avec sans que qui en au aux ce cette plus dont lorsque se il elle ont
    el los las una unos y o pero es son era fue ser ha han para por con sin que en del al se su más como cuando está lo no hay""".split()
)
LOW_PMI, UNSEEN, SEEN = -2.75, 0.05, 2  # UNSEEN: what a pair counts that fewer than SEEN other pages have
REPEATED_SHARE = 0.5
SENTENCES = 0.3  # share of function words from which on a page may be of sentences, where it is 0.34; in keywords below 0.12
CLEAR = 1.0  # what such a page must be below LOW_PMI
FOREIGN_LINKS, SUSPECT = 3, 0.25  # backlinks from other hosts that are suspicious, and what they raise LOW_PMI by
BLOCK = 500_000  # words after which a block of pages is closed; it bounds what a task holds, and changes no score
# KEY: the pos-th of a block's different words and pairs, on n of its pages. PAGE: the pairs of a page in data, n different
# ones, and its share of function words. PAIRS: the two words of each of the block's pairs in data; n is the number of words, which come before the pairs.
ROWS = "kind tinyint, block bigint, item_id bigint, key bigint, pos int, n bigint, share double, data binary"
KEY, PAGE, PAIRS = 0, 1, 2


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b
        x ^= x >> np.uint64(29)
        return x * np.uint64(0xBF58476D1CE4E5B9)


def _pack(x: np.ndarray) -> bytes:
    """Numbers below 2 ** 31 as bytes, the bytes of equal weight side by side, which compresses better."""
    return x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _batch(kind: int, block: int, m: int, **cols) -> pa.RecordBatch:
    types = {"item_id": pa.int64(), "key": pa.int64(), "pos": pa.int32(), "n": pa.int64(), "share": pa.float64(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(m, kind, np.int8)), pa.array(np.full(m, block, np.int64)), *(pa.array(cols[c], t) if c in cols else pa.nulls(m, t) for c, t in types.items())],
        ["kind", "block", *types],
    )


def _rows(block: int, items: list, starts: list[int], tokens: list[int], words: list[str]):
    """A block's batches. tokens: the words' places in `words`, with -1 after each line; starts: where each page begins."""
    t, w = np.array(tokens, np.int64), len(words)
    page = np.repeat(np.arange(len(items)), np.diff([*starts, len(t)]))
    here = t >= 0
    n_words = np.bincount(np.unique(page[here] * w + t[here]) % w, minlength=w)
    function = np.array([x in FUNCTION for x in words])[t[here]]
    share = np.bincount(page[here], function, len(items)) / np.bincount(page[here], minlength=len(items))
    two = here[:-1] & here[1:]
    codes, pairs = np.unique(t[:-1][two] * w + t[1:][two], return_inverse=True)
    page, p, a, b = page[:-1][two], len(codes), codes // w, codes % w
    hashes = np.array([key(x) for x in words], np.int64).view(np.uint64)
    keys = np.concatenate([hashes, _pair(hashes[a], hashes[b])]).view(np.int64)
    once = np.unique(page * p + pairs)
    n_pairs, different = (np.bincount(once % p, minlength=p), np.bincount(once // p, minlength=len(items))) if p else (np.zeros(0, np.int64), np.zeros(len(items), np.int64))
    yield _batch(KEY, block, w + p, key=keys, pos=np.arange(w + p, dtype=np.int32), n=np.concatenate([n_words, n_pairs]))
    held = np.flatnonzero(different)
    if len(held):
        ends = np.searchsorted(page, np.arange(len(items) + 1))
        yield _batch(PAGE, block, len(held), item_id=[items[i] for i in held], n=different[held], share=share[held], data=[_pack(pairs[ends[i] : ends[i + 1]]) for i in held])
        yield _batch(PAIRS, block, 1, n=[w], data=[_pack(np.concatenate([a, b]))])


def _scan(read):
    """The blocks of a task's pages."""
    block = TaskContext.get().partitionId() << 32
    items, starts, tokens, words = [], [], [], {}
    for _, item, lines, keep in read:
        start = len(tokens)
        for x, k in zip(lines, keep, strict=True):
            if k and (ws := WORD.findall(x.text.lower())):
                tokens += [words.setdefault(w, len(words)) for w in ws]
                tokens.append(-1)
        if len(tokens) > start:
            items.append(item)
            starts.append(start)
        if len(tokens) >= BLOCK:
            yield from _rows(block, items, starts, tokens, list(words))
            block += 1
            items, starts, tokens, words = [], [], [], {}
    if tokens:
        yield from _rows(block, items, starts, tokens, list(words))


SCORED = pa.schema([("item_id", pa.int64()), ("total", pa.int64()), ("pairs", pa.int64()), ("function", pa.float64()), ("sum", pa.float64()), ("square", pa.float64())])


def _score(held: pa.Table, known: pa.Table) -> pa.Table:
    """The sums of a block's pages. held: its rows PAGE and PAIRS; known: the document counts of its words and pairs."""
    out: list[tuple] = []
    kinds, items, different, shares, data = (held.column(c).to_pylist() for c in ("kind", "item_id", "n", "share", "data"))
    if PAIRS in kinds:
        at = kinds.index(PAIRS)
        w, (a, b) = different[at], _unpack(data[at]).reshape(2, -1)
        df = np.zeros(w + len(a))
        df[known.column("pos").to_numpy()] = known.column("df").to_numpy() - 1
        each = np.log(np.where(df[w:] >= SEEN, df[w:], 0.0) + UNSEEN) - np.log(np.maximum(np.minimum(df[a], df[b]), 1.0))
        for kind, item, pairs, share, x in zip(kinds, items, different, shares, data, strict=True):
            if kind == PAGE:
                v = each[_unpack(x)]
                out.append((item, len(v), pairs, share * len(v), v.sum(), (v * v).sum()))
    return pa.Table.from_arrays([pa.array([r[j] for r in out], f.type) for j, f in enumerate(SCORED)], schema=SCORED)


def scores(pages: DataFrame, learned: tuple | None = None) -> DataFrame:
    """(item_id, pmi, error, repeated, function) of every page with two neighbouring words. pages: (item_id, site, content_text);
    learned: their site_notes, if known.

    pmi: mean over the page's neighbouring words of ln(df(ab) / min(df(a), df(b))), with the numbers of other pages;
    error: its standard error; repeated: share of the page's pairs that it had before;
    function: share of function words.
    """
    scan = materialise(read_pages(pages, _scan, ROWS, learned), "p6-scan")
    counts = scan.filter(F.col("kind") == KEY).select("block", "pos", F.sum("n").over(Window.partitionBy("key")).alias("df"))
    known = counts.filter(F.col("df") > min(SEEN, 2))  # fewer count as none
    held = scan.filter(F.col("kind") != KEY).select("kind", "block", "item_id", "n", "share", "data")
    each = held.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_score, "item_id bigint, total bigint, pairs bigint, function double, sum double, square double")
    sums = each.groupBy("item_id").agg(*(F.sum(c).alias(c) for c in ("total", "pairs", "function", "sum", "square")))
    mean = {"sum": "pmi", "square": "square", "function": "function"}
    sums = sums.select("item_id", "pairs", *((F.col(c) / F.col("total")).alias(name) for c, name in mean.items()), (1 - F.col("pairs") / F.col("total")).alias("repeated"))
    return sums.select("item_id", "pmi", F.sqrt(F.greatest(F.col("square") - F.col("pmi") ** 2, F.lit(0.0)) / F.col("pairs")).alias("error"), "repeated", "function")


def _genuine(read):
    """(item_id) of the pages with no residue in the place of content (problem 3)."""
    last, ids = None, []
    out = lambda: pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["item_id"])
    for batch, item, lines, keep in read:
        if batch is not last and ids:
            yield out()
            ids = []
        last = batch
        if residue([(x.tag, x.text) for x, k in zip(lines, keep, strict=True) if k]) is None:
            ids.append(item)
    if ids:
        yield out()


def foreign_links(items: DataFrame, item: str, site: str, backlinks: str) -> DataFrame:
    """(item_id) of the items with FOREIGN_LINKS or more backlinks from other hosts than their own."""
    host = lambda c: F.regexp_extract(F.lower(c), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    away = F.filter(F.col(backlinks), lambda b: b["url"].isNotNull() & (host(b["url"]) != F.coalesce(host(F.col(site)), F.lit(""))))
    return items.filter(F.size(away) >= FOREIGN_LINKS).select(F.col(item).cast("bigint").alias("item_id")).distinct()


def spam_pages(items: DataFrame, *, item: str = "item_id", site: str = "site_url", text: str = "content_text", backlinks: str | None = "backlinks") -> DataFrame:
    """(item_id) of the pages of keywords, link lists or product tags.

    Rows without text, or without content of their own, give none. Rows that share an id are scored together; NULL and
    empty backlinks are unsuspicious, as are those of a table without the column; other columns are ignored; an empty table gives
    an empty result.
    """
    pages = pages_of(items, item, site, text).withColumn("page", F.unhex(F.md5("content_text")))
    one = pages.groupBy("site", "page").agg(F.min("item_id").alias("item_id"), F.min("content_text").alias("content_text"))
    one = one.select("item_id", "site", "content_text")
    learned = site_notes(one)
    scored = scores(one, learned)
    if backlinks is None or backlinks not in items.columns:
        low = scored.withColumn("line", F.lit(LOW_PMI))
    else:
        suspect = foreign_links(items, item, site, backlinks).withColumn("suspect", F.lit(SUSPECT))
        low = scored.join(suspect, "item_id", "left").withColumn("line", LOW_PMI + F.coalesce("suspect", F.lit(0.0)))
    short = F.col("function") < SENTENCES
    line = F.col("line") - F.when(short, 0.0).otherwise(CLEAR)
    low = low.filter((F.col("pmi") + F.col("error") <= line) | (F.col("repeated") >= REPEATED_SHARE) & short)
    low = materialise(low.select("item_id"), "p6-low")
    found = read_pages(pages.join(low, "item_id", "left_semi"), _genuine, "item_id bigint", learned).select(F.col("item_id").alias("rep"))
    ids = materialise(pages.select("item_id", "site", "page"), "p6-ids")
    same = ids.groupBy("site", "page").agg(F.min("item_id").alias("rep")).join(found, "rep", "left_semi")
    return ids.join(same.select("site", "page"), ["site", "page"], "left_semi").select("item_id")
