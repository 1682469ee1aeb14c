"""Problem 7: lines that one site repeats across its documents.

Method: numbers and dates (and, where asked, names) are masked, the lines of a site are clustered by locality-sensitive
hashing (min-wise hashes of the masked words), and clusters that occur in many documents of the site are removed.
`repeated_lines` adds an exact check after it: within a frequent cluster only lines whose own normal form is frequent count.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrand.llm.pages import DIGITS, key, normal, site_key, text_lines
from lodestrand.session import materialise, ship

# Names of months and days in the four languages of the corpus, masked as dates.
DATE_WORDS = frozenset(
    """january february march april may june july august september october november december
    monday tuesday wednesday thursday friday saturday sunday
    januar februar märz mai juni juli oktober dezember montag dienstag mittwoch donnerstag freitag samstag sonntag
    janvier février mars avril juin juillet août septembre octobre novembre décembre
    lundi mardi mercredi jeudi vendredi dimanche
    enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre
    lunes martes miércoles jueves viernes sábado domingo""".split()
)
WORD = re.compile(r"[^\W_]+")
MEMO = 400_000  # words whose hashes a Python worker keeps; a cache only, it is emptied when full

LINES = "item_id bigint, site bigint, cluster bigint, line bigint, nos array<int>"


class MinHash:
    """Two min-wise hashes over a line's masked words; equal word sets always get the same cluster."""

    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, int]] = {}

    def word(self, w: str) -> tuple[int, int]:
        h = self.memo.get(w)
        if h is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            h = self.memo[w] = (key(w), key("\x01" + w))
        return h

    def cluster(self, words: list[str]) -> int:
        pairs = [self.word(w) for w in words]
        return hash((min(p[0] for p in pairs), min(p[1] for p in pairs)))


def masked(norm: str, text: str, names: bool) -> list[str]:
    """The words of a line with dates as one sign. names: also capitalised words after the first, unless all are capitals."""
    if names and text != text.upper():
        first, *rest = WORD.findall(text)
        words = [first.lower(), *("\x02" if w[0].isupper() else w for w in rest)]
        words = [DIGITS.sub("0", w) for w in words]
    else:
        words = WORD.findall(norm)
    return ["\x03" if w in DATE_WORDS else w for w in words]


def _cut(names: bool):
    def cut(batches):
        mh = MinHash()
        memo: dict[str, tuple[int, int]] = {}
        for batch in batches:
            ids, sites, clusters, lines, nos = [], [], [], [], []
            for item, url, content in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                site, here = key(site_key(url)), {}
                for no, text in text_lines(content):
                    norm = normal(text)
                    at = norm if not names else (norm, text)
                    if (h := memo.get(at)) is None:
                        if len(memo) >= MEMO // 4:
                            memo.clear()
                        h = memo[at] = (mh.cluster(masked(norm, text, names)), key(norm))
                    here.setdefault(h, []).append(no)
                ids += [item] * (len(here) + 1)
                sites += [site] * (len(here) + 1)
                clusters += [0, *(h[0] for h in here)]
                lines += [0, *(h[1] for h in here)]
                nos += [[], *here.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sites, pa.int64()), pa.array(clusters, pa.int64()), pa.array(lines, pa.int64()), pa.array(nos, pa.list_(pa.int32()))],
                ["item_id", "site", "cluster", "line", "nos"],
            )
    return cut


def site_lines(items: DataFrame, *, names: bool = False, item: str = "item_id", site: str = "site_url", text: str = "content_text") -> DataFrame:
    """One row for each different line of an item: site, LSH cluster, normal form (both hashed) and line numbers.
    The row with line 0 stands for the item itself, so that items can be counted in the same pass."""
    ship(items.sparkSession)
    src = items.select(F.col(item).cast("bigint").alias("item_id"), F.col(site).alias("site_url"), F.col(text).alias("content_text"))
    return src.filter("content_text IS NOT NULL").mapInArrow(_cut(names), LINES)


def frequent(n: Column, total: Column, min_items: int, min_share: float) -> Column:
    return (n >= min_items) & (n >= F.lit(min_share) * total)


def repeated_lines(
    items: DataFrame, *, min_items: int = 8, min_share: float = 0.1, near: bool = False, item: str = "item_id", site: str = "site_url", text: str = "content_text"
) -> DataFrame:
    """(item_id, line_no) of each line that its site repeats in at least min_items items and min_share of its items with text.

    near=False: only lines equal but for case, white space, tags and digits count as repeated (the exact check).
    near=True: the whole LSH cluster counts, so lines that differ in a name or a word are removed too.
    Sites are compared without case and last slash; a NULL site is one source of its own. NULL text: no rows and not
    counted; empty text: no rows, counted as an item. Repeated item ids are different items. Other columns are ignored.
    """
    lines = materialise(site_lines(items, names=near, item=item, site=site, text=text), "p7-lines")
    body = lines.filter("nos IS NOT NULL AND size(nos) > 0")
    totals = lines.filter("size(nos) = 0").groupBy("site").agg(F.count("*").alias("total"))
    if near:
        # An item with several lines of one cluster counts once; both levels combine before they shuffle.
        per = body.groupBy("site", "cluster", "item_id").agg(F.lit(1).alias("one")).groupBy("site", "cluster").agg(F.count("*").alias("n"))
        hits = per.filter(F.col("n") >= min_items).join(totals, "site").filter(frequent(F.col("n"), F.col("total"), min_items, min_share)).select("site", "cluster")
        found = body.join(hits, ["site", "cluster"], "left_semi")
    else:
        each = body.groupBy("site", "cluster", "line").agg(F.count("*").alias("n"))
        clusters = each.groupBy("site", "cluster").agg(F.sum("n").alias("df")).filter(F.col("df") >= min_items)
        clusters = clusters.join(totals, "site").filter(frequent(F.col("df"), F.col("total"), min_items, min_share)).select("site", "cluster", "total")
        hits = each.filter(F.col("n") >= min_items).join(clusters, ["site", "cluster"]).filter(frequent(F.col("n"), F.col("total"), min_items, min_share))
        found = body.join(hits.select("site", "line"), ["site", "line"], "left_semi")
    return found.select("item_id", F.explode("nos").alias("line_no")).withColumn("line_no", F.col("line_no").cast("bigint"))


def without_lines(items: DataFrame, lines: DataFrame, *, item: str = "item_id", text: str = "content_text") -> DataFrame:
    """items with the given (item_id, line_no) taken out of the text; rows without any keep theirs. Item ids must be unique."""
    drop = lines.groupBy(F.col("item_id").alias("__item")).agg(F.collect_set("line_no").alias("__nos"))  # bounded by one item's lines
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(F.col("__nos"), (i + 1).cast("bigint"))), "\n")
    joined = items.join(drop, items[item] == drop["__item"], "left")
    return joined.withColumn(text, F.when(F.col("__nos").isNull(), F.col(text)).otherwise(kept)).drop("__item", "__nos")
