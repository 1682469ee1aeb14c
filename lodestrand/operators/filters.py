"""Predicates on URLs and pages, and what becomes of the rows they reject."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrand.config import CrawlConfig, java_regex
from lodestrand.functions.urls import extension, in_site, origin
from lodestrand.schema import HTML_TYPES


def matches_any(url: Column, patterns: tuple[str, ...]) -> Column:
    """Some pattern is found in the URL; False for no patterns. Each pattern keeps its own flags."""
    return reduce(lambda a, b: a | b, (url.rlike(java_regex(p)) for p in patterns), F.lit(False))


def first_match(url: Column, patterns: tuple[str, ...]) -> Column:
    """The text of the first pattern found, NULL for none."""
    return F.coalesce(*(F.when(url.rlike(java_regex(p)), F.lit(p)) for p in patterns), F.lit(None).cast("string"))


def verdict(url: Column, config: CrawlConfig) -> Column:
    """'ignored', 'not whitelisted', 'outside' or NULL for a URL to fetch, tested in that order."""
    out = F.when(matches_any(url, config.ignore), "ignored")
    if config.whitelist:
        out = out.when(~matches_any(url, config.whitelist), "not whitelisted")
    return out.when(~in_site(url, F.lit(config.site_url), config.strict_prefix), "outside")


def site_verdict(url: Column, site: Column, ignore: Column, whitelist: Column) -> Column:
    """The same with the options in columns, as of a table of crawls. NULL lists count as empty."""
    hit = lambda ps: F.coalesce(F.exists(ps, lambda p: F.regexp_like(url, p)), F.lit(False))
    return F.when(hit(ignore), "ignored").when((F.size(F.coalesce(whitelist, F.array().cast("array<string>"))) > 0) & ~hit(whitelist), "not whitelisted").when(~in_site(url, site), "outside")


def with_config(urls: DataFrame, configs: DataFrame, url: str = "url") -> DataFrame:
    """Each URL with the crawl of its host; URLs of hosts without a crawl are left out. Several crawls of a host: the
    longest site URL that the URL begins with, the longest of all where it begins with none."""
    named = configs.filter("site_url IS NOT NULL").select(F.struct("*").alias("config")).withColumn("__origin", origin("config.site_url"))
    one = named.groupBy("__origin").agg(F.collect_list("config").alias("configs"))  # the crawls of one host
    begins = lambda c: in_site(F.col(url), c["site_url"])
    best = F.element_at(F.array_sort("configs", lambda x, y: _order(begins, x, y)), 1)
    joined = urls.withColumn("__origin", origin(url)).join(one, "__origin").withColumn("config", best)
    return joined.drop("__origin", "configs")


def _order(begins, x: Column, y: Column) -> Column:
    rank = lambda c: F.when(begins(c), 0).otherwise(1)
    size = lambda c: F.length(c["site_url"])
    return (
        F.when(rank(x) != rank(y), rank(x) - rank(y))
        .when(size(x) != size(y), size(y) - size(x))
        .when(x["site_url"] < y["site_url"], -1)
        .when(x["site_url"] > y["site_url"], 1)
        .otherwise(0)
    )


def is_html(media_type: Column) -> Column:
    """Whether a response of this MIME type is parsed as a page."""
    return F.coalesce(media_type.isin(*HTML_TYPES), F.lit(False))


def within_size(text: Column, maxsize: Column | int | None) -> Column:
    """A page of at most so many characters; NULL is no limit."""
    limit = maxsize if isinstance(maxsize, Column) else F.lit(maxsize).cast("bigint")
    return limit.isNull() | (F.length(text) <= limit)


def can_emit(info: Column, text: Column, binary: Column) -> Column:
    """An item needs headers and content: a text that is not empty, or a file, which may be."""
    return F.coalesce((F.size(info) > 0) & (F.coalesce(F.length(text) > 0, F.lit(False)) | binary.isNotNull()), F.lit(False))


def drop_types(items: DataFrame, mimetypes: tuple[str, ...] = (), extensions: tuple[str, ...] = ()) -> DataFrame:
    """The rows with neither such a MIME type nor such a file extension; rows where both are NULL stay."""
    bad = F.coalesce(F.col("mimetype").isin(*mimetypes), F.lit(False)) | F.coalesce(extension("path").isin(*extensions), F.lit(False))
    return items.filter(~bad)


def keep_if(items: DataFrame, condition: str) -> DataFrame:
    """The rows for which an SQL expression holds."""
    return items.filter(F.expr(condition))


def robots_verdict(urls: DataFrame, rules: DataFrame, ignore_robots: bool = False) -> DataFrame:
    """urls with a column `allowed`. rules: (origin, prefix, allow): of the rules of its host whose prefix the URL's path
    begins with the longest decides, allowing ones first; without any a URL is allowed. Rows of urls are kept as they are."""
    if ignore_robots:
        return urls.withColumn("allowed", F.lit(True))
    per = rules.groupBy(F.lower("origin").alias("__origin")).agg(F.collect_list(F.struct("prefix", "allow")).alias("__rules"))  # one host's robots file
    path = F.regexp_replace(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    hits = F.filter("__rules", lambda r: F.startswith(F.when(path == "", "/").otherwise(path), r["prefix"]))
    best = F.array_max(F.transform(hits, lambda r: F.struct(F.length(r["prefix"]).alias("n"), r["allow"].alias("allow"))))
    return urls.withColumn("__origin", origin("url")).join(per, "__origin", "left").withColumn("allowed", F.coalesce(best["allow"], F.lit(True))).drop("__origin", "__rules")
