"""Consecutive numbers over a whole table without a window that gathers it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrand.session import materialise


def ranked(df: DataFrame, keys: list[str], name: str = "rank", *, within: str | None = None, parts: int | None = None) -> DataFrame:
    """df with a BIGINT column: its place, from 0, in the order of keys; with `within`, its place among the rows of the same
    value of that column, which must be the first key.

    The table is range-partitioned by sampled boundaries (the one shuffle), sorted and numbered within partitions; the
    counts of the partitions before it (one number each) are added. A hot value of `within` may lie across many
    partitions. Ties are numbered in an arbitrary but fixed order.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    # The number is the partition's, then the row's within it.
    held = materialise(placed, "ranked").withColumns({"__part": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))})
    before, total = [], 0
    for r in held.groupBy("__part").count().orderBy("__part").collect():  # a row for each partition
        before.append((r["__part"], total))
        total += r["count"]
    offsets = F.broadcast(spark.createDataFrame(before, "__part bigint, __before bigint"))
    out = held.join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__row")).drop("__part", "__row", "__id", "__before")
    if within is None:
        return out
    first = out.groupBy(within).agg(F.min(name).alias("__first"))
    return out.join(first.withColumnRenamed(within, "__within"), F.col(within).eqNullSafe(F.col("__within"))).withColumn(name, F.col(name) - F.col("__first")).drop("__first", "__within")
