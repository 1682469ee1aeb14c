"""The crawl: breadth-first traversal of links, ranks, backlinks, redirects and the items that come of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrand.config import CrawlConfig
from lodestrand.functions.urls import header, in_site, site_path
from lodestrand.operators.filters import can_emit, robots_verdict, verdict, within_size
from lodestrand.operators.ranking import ranked
from lodestrand.session import materialise


def seeds(spark, config: CrawlConfig) -> DataFrame:
    """(url, seq): the start URLs in their order, then the root; the root among them counts once, as the root."""
    root = config.site_url
    urls = [u for u in dict.fromkeys(config.start_urls) if u.rstrip("/") != root.rstrip("/")] + [root]
    return spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, seq bigint")


def seeds_of(configs: DataFrame) -> DataFrame:
    """(site_url, url, seq) of a table of crawls: `seeds` of each. A crawl without a site has none."""
    root = F.regexp_replace("site_url", "/$", "")
    own = F.filter(F.array_distinct(F.coalesce("start_urls", F.array().cast("array<string>"))), lambda u: u.isNotNull() & (F.regexp_replace(u, "/+$", "") != root))
    rows = configs.filter("site_url IS NOT NULL").select("site_url", F.posexplode(F.concat(own, F.array(F.concat(root, F.lit("/"))))).alias("seq", "url"))
    return rows.select("site_url", "url", F.col("seq").cast("bigint").alias("seq"))


def with_root(links: DataFrame, config: CrawlConfig) -> DataFrame:
    """Links to the site without its last slash lead to the root, which keeps it: they are one page."""
    return links.withColumn("dst", F.when(F.col("dst") == config.site_url.rstrip("/"), config.site_url).otherwise(F.col("dst")))


def traverse(start: DataFrame, edges: DataFrame, *, reject: Column | None = None, rules: DataFrame | None = None, max_pages: int | None = None, max_depth: int | None = None, order: bool = True) -> DataFrame:
    """(url, depth, place, reason): every URL that the start reaches, once.

    start: (url, seq); edges: (src, pos, dst). place is the order in which one queue would take the URLs: by round, then
    by the place of the page that first links there and the link's position. Rejected URLs (`reject` is an expression on
    `url`, its text becomes `reason`) count as taken but are not followed; nor are those that the robots rules (origin,
    prefix, allow) forbid, of which the reason is 'robots'. max_pages stops after so many URLs.
    order=False leaves place NULL and saves the sort of each round; max_pages needs order.

    Each round joins the frontier to the edges and takes out what is done; its result is written to the shared folder,
    so that the lineage stays one round long and a lost executor costs no more than a round.
    """
    spark = start.sparkSession
    why = reject if reject is not None else F.lit(None).cast("string")
    # Each pair of pages once, written: what makes the edges (parsing of pages, often) is done once, not in each round.
    links = edges.filter("src IS NOT NULL AND dst IS NOT NULL").groupBy("src", "dst").agg(F.min("pos").alias("pos"))
    links = materialise(links, "crawl-edges")
    first = start.filter("url IS NOT NULL").groupBy("url").agg(F.min("seq").alias("seq"))
    frontier = first.select("url", F.lit(0).cast("bigint").alias("parent"), F.col("seq").alias("at"))
    done: list[DataFrame] = []
    count, depth = 0, 0
    while True:
        placed = ranked(frontier, ["parent", "at", "url"], "place") if order else frontier.withColumn("place", F.lit(None).cast("bigint"))
        if order:
            placed = placed.withColumn("place", F.col("place") + count)
        if max_pages is not None:
            placed = placed.filter(F.col("place") < max_pages)
        reason = why
        if rules is not None:
            placed, reason = robots_verdict(placed, rules), F.coalesce(why, F.when(~F.col("allowed"), "robots"))
        level = materialise(placed.select("url", F.lit(depth).alias("depth"), "place", reason.alias("reason")), "crawl-level")
        size = level.count()
        if not size:
            break
        done.append(level)
        count += size
        depth += 1
        if (max_pages is not None and count >= max_pages) or (max_depth is not None and depth > max_depth):
            break
        go = level.filter("reason IS NULL").select(F.col("url").alias("src"), "place")
        found = links.join(go, "src").groupBy(F.col("dst").alias("url")).agg(F.min(F.struct("place", "pos")).alias("m"))
        seen = done[0].select("url")
        for d in done[1:]:
            seen = seen.unionByName(d.select("url"))
        frontier = found.join(seen, "url", "left_anti").select("url", F.coalesce("m.place", F.lit(0)).alias("parent"), F.col("m.pos").cast("bigint").alias("at"))
    if not done:
        return spark.createDataFrame([], "url string, depth int, place bigint, reason string")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def first_encounters(links: DataFrame) -> DataFrame:
    """(dst, seq, pos): for each link target its earliest occurrence; combined before the shuffle, so a target with a
    tenth of all links is one row a task. Refresh links are followed but give no rank."""
    return links.filter("dst IS NOT NULL AND (attr IS NULL OR attr <> 'refresh')").groupBy("dst").agg(F.min(F.struct("seq", "pos")).alias("m")).select("dst", "m.seq", "m.pos")


def sort_order(links: DataFrame) -> DataFrame:
    """(dst, sortorder): link targets numbered from 0 by first encounter. External targets count; ties go by URL."""
    return ranked(first_encounters(links), ["seq", "pos", "dst"], "sortorder").select("dst", "sortorder")


def backlink_rows(links: DataFrame) -> DataFrame:
    """(dst, place, url, name): every named link to a target, copies kept, numbered from 0 in order of discovery.

    The form without a bound: a target with a third of all links is spread over many tasks. Links of other attributes
    than href and src have no name and are none.
    """
    named = links.filter("dst IS NOT NULL AND attr IN ('href', 'src')").select("dst", "seq", "pos", F.col("src").alias("url"), "name")
    return ranked(named, ["dst", "seq", "pos", "url", "name"], "place", within="dst").select("dst", "place", "url", "name")


def backlinks(links: DataFrame, most: int | None = None) -> DataFrame:
    """(dst, n, backlinks): the number of a target's backlinks and these, or the first `most` of them, as an array."""
    rows = backlink_rows(links)
    item = F.struct("place", F.struct("url", "name").alias("b"))
    per = rows.groupBy("dst").agg(F.count("*").alias("n"), F.collect_list(item if most is None else F.when(F.col("place") < most, item)).alias("l"))
    return per.select("dst", "n", F.transform(F.array_sort("l"), lambda x: x["b"]).alias("backlinks"))


def backlink_counts(links: DataFrame) -> DataFrame:
    return links.filter("dst IS NOT NULL AND attr IN ('href', 'src')").groupBy("dst").agg(F.count("*").alias("n"))


def redirects(fetches: DataFrame) -> DataFrame:
    """(url, final_url) where a response came from elsewhere than asked."""
    return fetches.filter(F.col("url") != F.col("final_url")).select("url", "final_url").distinct()


def crawl_items(
    config: CrawlConfig, fetches: DataFrame, links: DataFrame, pages: DataFrame, *, order: DataFrame | None = None, backlinks_kept: int | None = None, rules: DataFrame | None = None, reached: DataFrame | None = None
) -> DataFrame:
    """The items of one crawl, from what was fetched: bad, redirect and content rows.

    fetches: one row for each url (see sources.store.latest); pages: (url, content_text, html_raw) of parsed pages by
    requested URL. Every URL reached from the seeds gives a bad row, or a content row, and a redirect row before it where
    it was redirected. A redirect that leaves the site is bad. Backlinks are those of the whole crawl, not of the moment;
    all of them become the array, or the first `backlinks_kept`. URLs that robots `rules` forbid are bad. The root's and
    the seeds' sort order is 0. reached: what `traverse` gave of these links, where that is known already.
    """
    spark = fetches.sparkSession
    links = with_root(links, config)
    if reached is None:
        reached = traverse(seeds(spark, config), links, reject=verdict(F.col("url"), config), rules=rules, max_pages=config.max)
    first = order if order is not None else sort_order(links)
    got = reached.join(fetches, "url", "left").join(pages, "url", "left")
    final = F.coalesce("final_url", F.col("url"))
    got = got.withColumn("final", F.regexp_replace(final, "#.*$", "")).withColumn("target", F.when(F.col("final") == config.site_url, F.col("final")).otherwise(F.regexp_replace("final", "/$", "")))
    back = backlinks(links, backlinks_kept).select(F.col("dst").alias("target"), "backlinks")
    got = got.join(back, "target", "left").join(first.select(F.col("dst").alias("url"), "sortorder"), "url", "left")
    text = F.when(within_size(F.col("content_text"), config.maxsize), F.col("content_text"))
    site = F.lit(config.site_url)
    fine = F.col("reason").isNull() & F.col("error").isNull() & F.coalesce(F.col("status") < 400, F.lit(True)) & in_site("final", site) & can_emit(F.col("content_info"), text, F.col("body"))
    base = got.withColumns({"fine": F.coalesce(fine, F.lit(False)), "from": site_path("url", site), "to": site_path("final", site), "seq": F.coalesce("sortorder", F.lit(0))})
    null = lambda t: F.lit(None).cast(t)
    bad = base.filter(~F.col("fine")).select(F.col("url").alias("bad_url"), "place", F.lit(1).alias("turn"))
    moved = base.filter(F.col("fine") & (F.col("url") != F.col("final")) & (F.col("from") != "")).select(
        "place", F.lit(0).alias("turn"), F.col("from").alias("path"), F.col("from").alias("orig_path"), site.alias("site_url"), F.col("to").alias("redir"), F.col("seq").alias("sortorder")
    )
    content = base.filter("fine").select(
        "place", F.lit(1).alias("turn"), F.col("to").alias("path"), F.col("to").alias("orig_path"), site.alias("site_url"), F.col("seq").alias("sortorder"),
        F.coalesce("backlinks", F.array().cast("array<struct<url:string,name:string>>")).alias("backlinks"), "content_info", text.alias("content_text"),
        F.when(text.isNull(), F.col("body")).alias("content_bin"), "html_raw",
    )
    out = bad.unionByName(moved, allowMissingColumns=True).unionByName(content, allowMissingColumns=True)
    for name in ("type", "mimetype", "remote_url", "text"):
        out = out.withColumn(name, null("string"))
    for name in ("file", "image"):
        out = out.withColumn(name, null("struct<data:binary,filename:string,mimetype:string>"))
    return out


def crawl_log(items: DataFrame) -> DataFrame:
    """(item_id, path, n_backlinks, size, content_type, date): what a crawl tells of each content row."""
    rows = items.filter("bad_url IS NULL AND redir IS NULL")
    return rows.select(
        "item_id", "path", F.greatest(F.coalesce(F.size("backlinks"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_backlinks"),
        F.coalesce(header("content_info", "content-length", "0").try_cast("bigint"), F.lit(0)).alias("size"),
        header("content_info", "content-type").alias("content_type"), header("content_info", "date").alias("date"),
    )


def kinds() -> Column:
    """bad, redirect or content."""
    return F.when(F.col("bad_url").isNotNull(), "bad").when(F.col("redir").isNotNull(), "redirect").otherwise("content")


def union_upstream(previous: DataFrame, own: DataFrame) -> DataFrame:
    """The rows of an earlier section and one's own, as a bag; columns that one side lacks are NULL."""
    return previous.unionByName(own, allowMissingColumns=True)
