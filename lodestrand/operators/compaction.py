"""Problem 2: many tiny files of records become few files of sound size that hold every whole record once.

Method: the records are range-partitioned by their clustering keys at boundaries taken from a sample, so that each
output file gets about `target_bytes`; each range is sorted and written; the counts of what was written are reconciled
with the counts of what was read, and only then is the new folder swapped for the old one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrand.session import materialise, remove

MB = 1 << 20


def whole_records(files: DataFrame) -> DataFrame:
    """The records of `body`, one JSON object to a line, with the site of their file.

    A line is a whole record if it is one complete JSON object with a rec_id that is an integer, as number or string.
    Blank lines, records not written to their end and lines of other JSON give no row; a NULL or empty body gives none.
    Copies are kept here: see `distinct_records`. Columns other than site_url and body are ignored.
    """
    # Splitting and parsing stay in the JVM: no Python worker sees a record.
    lines = files.select("site_url", F.explode(F.split("body", "\n")).alias("line")).select("site_url", F.trim(F.regexp_replace("line", r"^\s+|\s+$", "")).alias("line"))
    lines = lines.filter(F.col("line").startswith("{") & F.col("line").endswith("}"))
    # The parser stops after the first value; as an element of an array, what follows it on the line is seen.
    lines = lines.filter(F.json_array_length(F.concat(F.lit("["), F.col("line"), F.lit("]"))) == 1)
    v = F.try_parse_json("line")
    get = lambda name: F.try_variant_get(v, f"$.{name}", "string")
    rec = lines.select("site_url", get("rec_id").try_cast("bigint").alias("rec_id"), get("_path").alias("path"), get("_type").alias("type"), get("title").alias("title"), get("note").alias("note"))
    return rec.filter("rec_id IS NOT NULL")


def distinct_records(records: DataFrame) -> DataFrame:
    """One row for each rec_id: of several, the least by (site_url, path, title, type, note), NULLs first.

    The aggregation combines before it shuffles, so a record that stands in a third of all files is one row a task.
    """
    cols = [c for c in records.columns if c != "rec_id"]
    order = [c for c in ("site_url", "path", "title", "type", "note") if c in cols] + sorted(set(cols) - {"site_url", "path", "title", "type", "note"})
    return records.groupBy("rec_id").agg(F.min(F.struct(*order)).alias("r")).select("rec_id", *(F.col("r")[c].alias(c) for c in cols))


@dataclass(frozen=True)
class Report:
    """What `compact` did: rows and a checksum on either side, and the number of ranges, of which empty ones have no file."""

    rows: int
    checksum: int
    files: int


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Rows of df and the sum of their hashes, which no loss, copy or change of a row leaves as it was."""
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return int(row["n"]), int(row["h"])


def size_estimate(df: DataFrame) -> int:
    """Bytes of df as text: the sum of the lengths of its columns, over all rows."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()["b"])


def compact(records: DataFrame, target: str, *, keys: list[str], target_bytes: int = 128 * MB) -> Report:
    """Write `records` into the folder `target` as sorted files of about target_bytes, ordered by keys across files.

    Spark samples the boundaries of the ranges (repartitionByRange); keys should end in a unique column, so that no
    boundary falls on a hot key and a site with a third of all rows is spread over a third of the files. The rows are
    written beside the target and counted again there; if a count or checksum differs, nothing is swapped and
    RuntimeError is raised. An empty input gives an empty folder with the schema. NULL keys sort first.
    """
    spark = records.sparkSession
    before = fingerprint(records)
    parts = max(1, -(-size_estimate(records) // target_bytes))
    staging = f"{target}.staging"
    remove(spark, staging)
    records.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.mode("error").parquet(staging)
    written = spark.read.schema(records.schema).parquet(staging)
    after = fingerprint(written)
    if before != after:
        remove(spark, staging)
        raise RuntimeError(f"{before} rows and checksum went in, {after} came out; {target} is left as it was")
    swap(spark, staging, target)
    return Report(after[0], after[1], parts)


def swap(spark: SparkSession, new: str, live: str) -> None:
    """Put the folder `new` in the place of `live` by two renames; on failure of the second the first is undone. A run
    that died between the two left `live` only as `.old`: that is put back first."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(live).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{live}.old"
    if not fs.exists(path(live)) and fs.exists(path(old)) and not fs.rename(path(old), path(live)):
        raise RuntimeError(f"{old} cannot be put back to {live}")
    remove(spark, old)
    had = fs.exists(path(live))
    if had and not fs.rename(path(live), path(old)):
        raise RuntimeError(f"{live} cannot be moved away")
    if not fs.rename(path(new), path(live)):
        if had:
            fs.rename(path(old), path(live))
        raise RuntimeError(f"{new} cannot be moved to {live}")
    remove(spark, old)


def compact_cache(files: DataFrame, target: str, *, target_bytes: int = 128 * MB) -> DataFrame:
    """The whole pass over a crawl cache: parse, drop copies, compact into `target`, and read the result."""
    records = materialise(distinct_records(whole_records(files)), "p2-records")
    compact(records, target, keys=["site_url", "path", "rec_id"], target_bytes=target_bytes)
    return records.sparkSession.read.schema(records.schema).parquet(target)
