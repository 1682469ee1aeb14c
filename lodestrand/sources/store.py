"""The fetch store: responses kept as a Parquet table or as a tree of files, read before anything is fetched."""

from __future__ import annotations

import configparser
import os
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.functions.urls import guess_mime, http_date, quote
from lodestrand.schema import FETCH, INDEX_NAMES

SIDECAR = ".metadata"


class Fetcher(Protocol):
    """Live fetching. Called on executors with the URLs of one partition; yields FETCH rows as tuples."""

    def __call__(self, urls: Iterator[str]) -> Iterator[tuple]: ...


def latest(fetches: DataFrame) -> DataFrame:
    """One row for each URL: the last visit, of equal times the one loaded last; NULL times are the earliest.

    One aggregation that combines before it shuffles, so a URL that was loaded very often is one row a task.
    """
    rest = [c for c in fetches.columns if c not in ("url", "content_info")]
    # Maps have no order; they ride along as entries.
    row = fetches.filter("url IS NOT NULL").select("url", F.struct("fetched_at", "loaded_at", *(F.col(c) for c in rest if c not in ("fetched_at", "loaded_at")), F.array_sort(F.map_entries("content_info")).alias("__info")).alias("r"))
    best = row.groupBy("url").agg(F.max("r").alias("r"))
    out = best.select("url", *(F.col("r")[c].alias(c) for c in rest), F.map_from_entries(F.col("r")["__info"]).alias("content_info"))
    return out.select(*fetches.columns)


def look_up(urls: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): the distinct URLs with their kept response, and those without one."""
    asked = urls.select("url").filter("url IS NOT NULL").distinct()
    return asked.join(latest(store), "url"), asked.join(store.select("url"), "url", "left_anti")


def fetch_missing(urls: DataFrame, store: DataFrame, fetcher: Fetcher, path: str | None = None) -> DataFrame:
    """The responses of all URLs, cache first: misses are fetched and, with a path, appended to the store there.
    Misses are spread by host so that one host is asked from one task."""
    hits, misses = look_up(urls, store)
    spread = misses.repartition(F.regexp_extract("url", r"^[^/]*//([^/?#]*)", 1))
    rows = spread.rdd.mapPartitions(lambda it: fetcher(r["url"] for r in it))  # a fetch is imperative: the one use of an RDD
    got = urls.sparkSession.createDataFrame(rows, FETCH)
    if path:
        got.write.mode("append").parquet(path)
        got = urls.sparkSession.read.schema(FETCH).parquet(path).join(misses, "url", "left_semi")
    return hits.unionByName(got)


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified, content) of every file below root, names that begin with a dot included; path is relative.

    Spark's own scan leaves dot files out, so the names are listed by the file system and contents read by executors
    only where they are asked for. Only names come to the driver, no contents.
    """
    jvm, sc = spark._jvm, spark.sparkContext
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(sc._jsc.hadoopConfiguration())
    base = fs.makeQualified(base)
    prefix = base.toUri().getPath().rstrip("/") + "/"
    shown = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    seen = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:(//[^/]*)?", ""), "^/+", "/")
    names = shown.select(F.substr(seen, F.lit(len(prefix) + 1)).alias("path"), "length", F.col("modificationTime").cast("timestamp_ntz").alias("modified"), "content")
    hidden = []
    it = fs.listFiles(base, True)
    while it.hasNext():
        s = it.next()
        p = s.getPath().toUri().getPath()[len(prefix):]
        if any(x.startswith((".", "_")) for x in p.split("/")) and not p.endswith(".crc"):
            hidden.append((p, s.getLen(), s.getModificationTime() / 1000.0, s.getPath().toString()))
    if not hidden:
        return names
    own = spark.createDataFrame(hidden, "path string, length bigint, at double, full string")
    read = F.udf(_read, "binary")
    own = own.select("path", "length", F.timestamp_seconds("at").cast("timestamp_ntz").alias("modified"), read("full").alias("content"))
    return names.unionByName(own).dropDuplicates(["path"])


def _read(full: str) -> bytes:
    from urllib.parse import unquote, urlparse

    with open(unquote(urlparse(full).path), "rb") as f:
        return f.read()


def sidecar_headers(text: str | None) -> dict[str, str]:
    """The headers of a sidecar: the section `metadata` of an INI file, without interpolation, names in lower case."""
    if not text:
        return {}
    parser = configparser.RawConfigParser(strict=False)
    try:
        parser.read_string(text)
    except configparser.Error:
        return {}
    return {k.lower(): v for k, v in parser.items("metadata")} if parser.has_section("metadata") else {}


def headers_of(files: DataFrame) -> DataFrame:
    """(path, content_info) of files (path, length, modified, content), sidecars read and left out: a file with a sidecar
    has its headers; another has a content-type by its name (text/plain for unknown ones), its length and its date.
    A sidecar without a file has a row too: it is a redirect or an empty text."""
    parse = F.udf(lambda b: sidecar_headers(bytes(b).decode("utf-8", "replace") if b is not None else None), "map<string,string>")
    side = files.filter(F.endswith("path", F.lit(SIDECAR))).select(F.expr(f"left(path, length(path) - {len(SIDECAR)})").alias("path"), parse("content").alias("given"))
    own = files.filter(~F.endswith("path", F.lit(SIDECAR)))
    made = F.create_map(
        F.lit("content-type"), F.coalesce(guess_mime("path"), F.lit("text/plain")), F.lit("content-length"), F.col("length").cast("string"), F.lit("last-modified"), http_date("modified")
    )
    joined = own.select("path", "length", "modified", "content").join(side, "path", "full")
    return joined.select("path", F.when(F.col("given").isNotNull() & (F.size("given") > 0), F.col("given")).otherwise(made).alias("content_info"), "content")


def index_of(paths: DataFrame) -> DataFrame:
    """(directory, path) for every directory that has an index: the file of the first of INDEX_NAMES that it holds."""
    order = F.array(*(F.lit(n) for n in INDEX_NAMES))
    name = F.element_at(F.split("path", "/"), -1)
    at = F.array_position(order, name)
    rows = paths.select("path", F.regexp_replace("path", "[^/]*$", "").alias("directory"), at.alias("at")).filter("at > 0")
    return rows.groupBy("directory").agg(F.min_by("path", F.struct("at", "path")).alias("path"))


def listing_rows(paths: DataFrame) -> DataFrame:
    """(directory, name, is_directory): the entries of every directory, once each. '' is the root."""
    parts = F.split("path", "/")
    depth = F.sequence(F.lit(1), F.size(parts))
    rows = paths.filter("path IS NOT NULL AND path <> ''").select(F.explode(F.transform(depth, lambda i: F.struct(F.array_join(F.slice(parts, F.lit(1), i - 1), "/").alias("directory"), F.element_at(parts, i.cast("int")).alias("name"), (i < F.size(parts)).alias("is_directory")))).alias("r"))
    return rows.select("r.directory", "r.name", "r.is_directory").filter("name <> ''").groupBy("directory", "name").agg(F.max("is_directory").alias("is_directory"))


def listing_html(entries: DataFrame, base: str) -> DataFrame:
    """(directory, html): a page that links every entry of a directory in order of names, for directories without index.
    One directory's page holds all its entries, as a page must."""
    link = F.concat(F.lit('<A HREF="'), quote(F.col("name")), F.when(F.col("is_directory"), F.lit("/")).otherwise(F.lit("")), F.lit('">'), F.col("name"), F.lit("</A>"))
    per = entries.select("directory", F.struct("name", link.alias("link")).alias("e")).groupBy("directory").agg(F.array_sort(F.collect_list("e")).alias("es"))
    head = F.concat(F.lit(f'<BASE HREF="{base.rstrip("/")}/'), quote(F.col("directory")), F.when(F.col("directory") == "", F.lit("")).otherwise(F.lit("/")), F.lit('">\n'))
    return per.select("directory", F.concat(head, F.array_join(F.transform("es", lambda e: e["link"]), "\n"), F.lit("\n")).alias("html"))


def tree_fetches(spark: SparkSession, root: str, site_url: str) -> DataFrame:
    """FETCH rows of a tree of files as the site at site_url: files, directories by their index or a listing, and
    redirects (sidecars with a Location), of which the final URL is followed one step."""
    site = site_url if site_url.endswith("/") else site_url + "/"
    files = read_tree(spark, root)
    heads = headers_of(files)
    url = lambda path: F.concat(F.lit(site), path)
    place = F.element_at("content_info", "location")
    plain = heads.select(url("path").alias("url"), F.coalesce(place, url("path")).alias("final_url"), F.when(place.isNotNull(), 302).otherwise(200).alias("status"), "content_info", F.col("content").alias("body"))
    index = index_of(heads.select("path")).join(heads, "path")
    dirs = index.select(url("directory").alias("url"), url("directory").alias("final_url"), F.lit(200).alias("status"), "content_info", F.col("content").alias("body"))
    entries = listing_rows(heads.select("path"))
    bare = entries.join(index.select(F.regexp_replace("directory", "/$", "").alias("directory")), "directory", "left_anti")
    pages = listing_html(bare, "file://" + os.path.abspath(root))
    folder = F.when(F.col("directory") == "", "").otherwise(F.concat("directory", F.lit("/")))
    lists = pages.select(url(folder).alias("url"), url(folder).alias("final_url"), F.lit(200).alias("status"), F.create_map(F.lit("content-type"), F.lit("text/html")).alias("content_info"), F.encode("html", "UTF-8").alias("body"))
    null = lambda t: F.lit(None).cast(t)
    out = plain.unionByName(dirs).unionByName(lists)
    return out.withColumns({"html": null("string"), "error": null("string"), "fetched_at": null("timestamp_ntz"), "loaded_at": null("timestamp_ntz")})
