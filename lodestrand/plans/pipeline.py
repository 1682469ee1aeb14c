"""Pipelines: sections by name, chained as DataFrame transforms, from an INI text or from Python."""

from __future__ import annotations

import configparser
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from urllib.parse import urlsplit
from urllib.request import url2pathname

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.config import CrawlConfig
from lodestrand.functions.urls import header, media_type
from lodestrand.operators import crawl, filters, pages, recognise
from lodestrand.schema import FETCH
from lodestrand.sinks import cache
from lodestrand.sources import store

Section = Callable[["Context", Mapping[str, str], DataFrame | None], DataFrame | None]
SECTIONS: dict[str, Section] = {}


@dataclass
class Context:
    """What sections share: the session, named DataFrames they may read (such as `fetches`), and what fetches live."""

    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)
    fetcher: store.Fetcher | None = None


def section(name: str) -> Callable[[Section], Section]:
    """Register a section under a name; a later one of the same name replaces it."""

    def add(f: Section) -> Section:
        SECTIONS[name] = f
        return f

    return add


@section("webcrawler")
def _crawl(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    """Upstream rows, then those of the crawl. Without a site only the upstream. Responses come from the table `fetches`,
    or from the tree of files in the option `cache`. Rules of robots files come from the table `robots` (origin, prefix,
    allow), unless `ignore_robots`; without that table everything is allowed. A site of a file URL is read from its
    folder. With the context's `fetcher` what is reached but not kept is fetched, until nothing is missing."""
    if not (options.get("site_url") or options.get("url")):
        return previous
    config = CrawlConfig.of(options)
    fetches = ctx.tables.get("fetches")
    if config.cache:
        tree = store.tree_fetches(ctx.spark, config.cache, config.site_url)
        fetches = tree if fetches is None else tree.unionByName(fetches.join(tree.select("url"), "url", "left_anti"))
    if config.site_url.startswith("file:"):
        tree = store.tree_fetches(ctx.spark, url2pathname(urlsplit(config.site_url).path), config.site_url)
        fetches = tree if fetches is None else fetches.unionByName(tree.join(fetches.select("url"), "url", "left_anti"))
    if fetches is None and ctx.fetcher is None:
        raise ValueError("a crawl needs the table fetches, the option cache, a file URL or a fetcher")
    fetches = ctx.spark.createDataFrame([], FETCH) if fetches is None else store.latest(fetches)
    rules = None if config.ignore_robots else ctx.tables.get("robots")
    while True:
        clean, edges, html = _parsed(config, fetches)
        reached = crawl.traverse(crawl.seeds(ctx.spark, config), edges, reject=filters.verdict(F.col("url"), config), rules=rules, max_pages=config.max)
        if ctx.fetcher is None:
            break
        missing = reached.filter("reason IS NULL").select("url").join(fetches.select("url"), "url", "left_anti")
        if missing.isEmpty():
            break
        got = cache.materialise(store.fetch_missing(missing, fetches, ctx.fetcher), "fetched")
        silent = missing.join(got.select("url"), "url", "left_anti").select("url", F.col("url").alias("final_url"), F.lit("no response").alias("error"))
        fetches = fetches.unionByName(got.select(*fetches.columns)).unionByName(silent, allowMissingColumns=True)
        fetches = cache.materialise(fetches.select(*got.columns), "fetches")
    ordered = edges.join(reached.select(F.col("url").alias("src"), "place"), "src").withColumn("seq", F.col("place")).drop("place")
    body = fetches.withColumn("body", F.when(~html, F.col("body")))
    items = crawl.crawl_items(config, body, ordered, clean, rules=rules, reached=reached).drop("place", "turn")
    return items if previous is None else crawl.union_upstream(previous, items)


def _parsed(config: CrawlConfig, fetches: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """(pages, links, test for HTML) of responses, each parsed once: both tables are written."""
    html = filters.is_html(media_type(header("content_info", "content-type")))
    page = fetches.filter(html)
    decoded = pages.decode_pages(page.filter("html IS NULL").select("url", "body", header("content_info", "content-type").alias("content_type")))
    raw = page.filter("html IS NOT NULL").select("url", "html").unionByName(decoded).filter("html IS NOT NULL")
    raw = raw.filter(filters.within_size(F.col("html"), config.maxsize))
    patched = raw.select("url", F.col("html").alias("html_raw"), pages.patched(F.col("html"), config).alias("html"))
    # Links are relative to where a page was found, and belong to the URL that was asked for.
    links = pages.extract_links(patched.join(fetches.select("url", "final_url"), "url").select(F.coalesce("final_url", "url").alias("url"), F.lit(0).alias("seq"), "html"))
    asked = fetches.select(F.coalesce("final_url", "url").alias("src"), F.col("url").alias("asked"))
    edges = crawl.with_root(links.join(asked, "src").withColumn("src", F.col("asked")).drop("asked"), config)
    clean = pages.clean_pages(patched.select("url", "html")).join(patched.select("url", "html_raw"), "url")
    return cache.materialise(clean, "crawl-pages"), cache.materialise(edges, "crawl-links"), html


@section("typerecognitor")
def _recognise(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    return recognise.recognise(previous)


@section("cache")
def _cache(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    """Keep items below the option `output`; without it they pass as they are. `path-key` names another path column."""
    if not options.get("output"):
        return previous
    key = options.get("path-key", "path").strip().lstrip("_")
    kept = cache.spill(previous)
    cache.export_tree(kept if key == "path" else kept.withColumn("path", F.col(key)), options["output"].rstrip("/"))
    return kept


@section("itemcache")
def _spill(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    return cache.spill(previous)


@section("condition")
def _condition(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    return filters.keep_if(previous, options["condition"])


@section("delete")
def _delete(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    return previous.drop(*options["delete"].split())


@section("print")
def _print(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    """Show the first rows (option `rows`, 20) and hand all on."""
    previous.show(int(options.get("rows", "20")), truncate=int(options.get("width", "80")))
    return previous


@section("inline")
def _inline(ctx: Context, options: Mapping[str, str], previous: DataFrame | None) -> DataFrame | None:
    """Rows written in the pipeline: one `path=html` to a line of the option `pages`."""
    rows = [line.split("=", 1) for line in options["pages"].strip().split("\n") if "=" in line]
    own = ctx.spark.createDataFrame([(p.strip(), h.strip()) for p, h in rows], "path string, html_raw string")
    own = own.withColumn("site_url", F.lit(options.get("site_url", "http://inline.test/")))
    return own if previous is None else crawl.union_upstream(previous, own)


def run(ctx: Context, sections: list[tuple[str, Mapping[str, str]]]) -> DataFrame | None:
    """Chain sections (name, options); each gets what the one before gives."""
    out: DataFrame | None = None
    for name, options in sections:
        if name not in SECTIONS:
            raise KeyError(f"no section is called {name}; there are {', '.join(sorted(SECTIONS))}")
        out = SECTIONS[name](ctx, options, out)
    return out


def run_ini(ctx: Context, text: str, extra: str | None = None) -> DataFrame | None:
    """Run the pipeline of an INI text: [pipeline] lists section titles, each with `blueprint` and its options. A second
    text may change options and add to or take from the list with `pipeline +=` and `pipeline -=`."""
    parser = configparser.RawConfigParser(strict=False)
    parser.read_string(text)
    names = parser.get("pipeline", "pipeline").split()
    if extra:
        more = configparser.RawConfigParser(strict=False)
        more.read_string(extra)
        for title in more.sections():
            for key, value in more.items(title):
                if title == "pipeline" and key == "pipeline +":
                    names += value.split()
                elif title == "pipeline" and key == "pipeline -":
                    names = [n for n in names if n not in value.split()]
                elif title == "pipeline":
                    names = value.split()
                else:
                    if not parser.has_section(title):
                        parser.add_section(title)
                    parser.set(title, key, value)
    steps = []
    for title in names:
        options = dict(parser.items(title))
        steps.append((options.pop("blueprint", title).rsplit(".", 1)[-1], options))
    return run(ctx, steps)
