"""Keeping items: as rows of a fetch store, or as a tree of files with sidecars."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrand.functions.urls import cache_file
from lodestrand.schema import FETCH
from lodestrand.session import materialise
from lodestrand.sources.store import SIDECAR


def routed_content(path: str = "path") -> Column:
    """The bytes to keep of an item: a redirect has none; else the field of its type, else the raw page, else the content."""
    field = (
        F.when(F.col("type") == "Document", F.encode("text", "UTF-8"))
        .when(F.col("type") == "File", F.col("file.data"))
        .when(F.col("type") == "Image", F.col("image.data"))
        .when(F.col("type").isin("Folder", "ContentFolder"), F.lit(None).cast("binary"))
        .otherwise(F.coalesce(F.encode("html_raw", "UTF-8"), F.encode("content_text", "UTF-8"), F.col("content_bin")))
    )
    return F.when(F.col("redir").isNull(), field)


def with_files(items: DataFrame, path: str = "path") -> DataFrame:
    """items with `cache_path` and `cache_data`: the file each is kept in and its bytes (NULL: a sidecar alone).

    A path that is also a directory of other paths is kept in that directory's `.content`, and one that ends in a slash
    or is empty in `index.html`. Items without path have NULL. The directories are found by one join on their names.
    """
    name = cache_file(F.col(path))
    segments = F.split(F.col(path), "/")
    upper = items.filter(F.col(path).isNotNull() & (F.col(path) != "")).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(segments) - 1, F.lit(1))), lambda i: F.array_join(F.slice(segments, F.lit(1), i), "/"))).alias("__dir"), F.size(segments).alias("n")
    ).filter("n > 1").select("__dir").distinct()
    joined = items.join(upper.withColumn("__is_dir", F.lit(True)), F.col(path) == F.col("__dir"), "left")
    return joined.withColumn("cache_path", F.when(F.col("__is_dir"), F.concat(F.col(path), F.lit("/.content"))).otherwise(name)).withColumn("cache_data", routed_content(path)).drop("__dir", "__is_dir")


def headers_to_keep() -> Column:
    """An item's headers; of a redirect only the Location, absolute."""
    return F.when(F.col("redir").isNotNull(), F.create_map(F.lit("location"), F.concat("site_url", F.col("redir")))).otherwise(F.col("content_info"))


def store_rows(items: DataFrame) -> DataFrame:
    """FETCH rows of items, to append to a Parquet store: rows without path or site are left out."""
    url = F.concat(F.regexp_replace("site_url", "/$", ""), F.lit("/"), F.col("path"))
    final = F.when(F.col("redir").isNotNull(), F.concat(F.regexp_replace("site_url", "/$", ""), F.lit("/"), F.col("redir"))).otherwise(url)
    out = items.filter("path IS NOT NULL AND site_url IS NOT NULL").withColumn("__h", headers_to_keep()).select(
        url.alias("url"), final.alias("final_url"), F.when(F.col("redir").isNotNull(), 302).otherwise(200).alias("status"), F.col("__h").alias("content_info"), routed_content().alias("body"),
        "html_raw",
    ).withColumnRenamed("html_raw", "html")
    null = lambda t: F.lit(None).cast(t)
    return out.withColumns({"error": null("string"), "fetched_at": null("timestamp_ntz"), "loaded_at": null("timestamp_ntz")})


def append_new(items: DataFrame, store_path: str) -> DataFrame:
    """Append to the store at store_path what it does not hold already; gives the items on unchanged."""
    spark = items.sparkSession
    rows = store_rows(items)
    try:
        there = spark.read.schema(FETCH).parquet(store_path)
        rows = rows.join(there.select("url", "body", "final_url"), on=[rows["url"] == there["url"], rows["body"].eqNullSafe(there["body"]), rows["final_url"].eqNullSafe(there["final_url"])], how="left_anti")
    except Exception as e:  # no store yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    materialise(rows, "new-rows").write.mode("append").parquet(store_path)
    return items


def export_tree(items: DataFrame, root: str) -> None:
    """Write items as files below root (a path that executors share), each with its headers beside it. Rows without path
    are left out. Paths that climb out of root are refused by raising ValueError."""
    kept = with_files(items).filter("cache_path IS NOT NULL").select("cache_path", "cache_data", headers_to_keep().alias("headers"))
    base = os.path.abspath(root)

    def write(rows):
        for r in rows:
            full = os.path.abspath(os.path.join(base, r["cache_path"]))
            if not full.startswith(base + os.sep):
                raise ValueError(f"{r['cache_path']} lies outside {base}")
            os.makedirs(os.path.dirname(full), exist_ok=True)
            if r["cache_data"] is not None:
                with open(full, "wb") as f:
                    f.write(r["cache_data"])
            if r["headers"]:
                lines = "".join(f"{k} = {v}\n".replace("\r", "") for k, v in sorted(r["headers"].items()) if v is not None)
                with open(full + SIDECAR, "w", encoding="utf-8") as f:
                    f.write("[metadata]\n" + lines)

    kept.foreachPartition(write)


def spill(items: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there: what is upstream is not computed again."""
    return materialise(items, "items")
