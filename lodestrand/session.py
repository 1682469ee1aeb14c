"""What every operator needs of a session: tables, the shared folder and intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of the directory `sf_dir` (one file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own in local mode. On a cluster there is
    no such folder unless the setting names it, so its absence is an error there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="lodestrand-")
        _own.append(folder[len("file://"):])
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder. It is removed when the driver ends."""
    own = f"{shared_dir(spark)}/lodestrand-{spark.sparkContext.applicationId}"
    sc = spark.sparkContext
    if getattr(sc, "_lodestrand_scratch", None) != own:
        target = spark._jvm.org.apache.hadoop.fs.Path(own)
        fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        fs.deleteOnExit(target)  # by whatever file system it lies on, when the driver's JVM ends
        sc._lodestrand_scratch = own
    return f"{own}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, *, partition_by: list[str] | None = None) -> DataFrame:
    """Write df once into the shared folder and read it back: cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    writer = df.write.mode("error").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    jvm, sc = spark._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors of a cluster; nothing to do in local mode."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_lodestrand_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lodestrand-ship-")
    _own.append(folder)
    name = os.path.join(folder, "lodestrand.zip")
    with zipfile.ZipFile(name, "w") as z:
        for root, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("lodestrand", os.path.relpath(full, here)))
    sc.addPyFile(name)
    sc._lodestrand_shipped = True


@atexit.register
def _tidy() -> None:
    for path in _own:
        shutil.rmtree(path, ignore_errors=True)
