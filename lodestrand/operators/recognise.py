"""Type recognition: an item's type from its MIME type, its content in the field of the type, and a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrand.functions.urls import filename, guess_mime, header, media_type, relative_url
from lodestrand.schema import MIME_TYPES, OTHER_TYPE


def recognise(items: DataFrame, *, route: bool = True) -> DataFrame:
    """ITEM rows with type, mimetype and remote_url, and the content moved to text, file or image.

    Bad and already typed rows stay as they are. Redirects become Links with the target as seen from their path. Rows
    without path or content stay as they are. Of the rest the MIME type is that of the content-type header, or by the
    path's extension where there is none; an unknown one makes a File. Row-local: works on streams too.
    The table of types is 17 literals in the plan, so no join and no shuffle.
    """
    have = F.col("content_text").isNotNull() | F.col("content_bin").isNotNull()
    open_ = F.col("bad_url").isNull() & F.col("type").isNull()
    link = open_ & F.col("redir").isNotNull()
    typed = open_ & F.col("redir").isNull() & F.col("path").isNotNull() & have
    given = header("content_info", "content-type", None)
    mime = F.when(given.isNotNull(), media_type(given)).otherwise(guess_mime("path"))
    table = F.create_map(*(F.lit(x) for kv in MIME_TYPES.items() for x in kv))
    kind = F.coalesce(F.element_at(table, mime), F.lit(OTHER_TYPE))
    out = items.withColumns({
        "__typed": typed,
        "mimetype": F.when(typed, mime).otherwise(F.col("mimetype")),
        "remote_url": F.when(link, relative_url("path", "redir")).otherwise(F.col("remote_url")),
        "type": F.when(link, "Link").when(typed, kind).otherwise(F.col("type")),
    })
    if not route:
        return out.drop("__typed")
    data = F.coalesce(F.col("content_bin"), F.encode("content_text", "UTF-8"))
    file = F.struct(data.alias("data"), filename("path").alias("filename"), F.col("mimetype").alias("mimetype"))
    is_ = lambda t: F.col("__typed") & (F.col("type") == t)
    out = out.withColumns({
        "file": F.when(is_("File"), file).otherwise(F.col("file")),
        "image": F.when(is_("Image"), file).otherwise(F.col("image")),
        "text": F.when(is_("Document"), F.coalesce("content_text", F.col("content_bin").cast("string"))).otherwise(F.col("text")),
    })
    none = lambda name: F.when(~F.col("__typed"), F.col(name))
    return out.withColumns({name: none(name) for name in ("content_text", "content_bin", "html_raw")}).drop("__typed")


def summary(before: DataFrame) -> DataFrame:
    """(type, mimetype, n) of what `recognise` gives a type to: rows already typed, bad or incomplete are not counted.
    Links are counted under the MIME type ''."""
    fresh = before.filter("bad_url IS NULL AND type IS NULL")
    out = recognise(fresh, route=False).filter("type IS NOT NULL").withColumn("mimetype", F.when(F.col("type") == "Link", "").otherwise(F.coalesce("mimetype", F.lit(""))))
    return out.groupBy("type", "mimetype").agg(F.count("*").alias("n"))
