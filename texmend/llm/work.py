"""Shared-folder tables: how operators cut lineage so that a lost executor costs one stage."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bytes of one Arrow batch between Spark and a Python worker, and its rows, whichever comes first.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset and driver and executors are one process or one machine's (master local), a new temporary folder
    is set; on a cluster that is an error, as executors would write to disks of their own.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="texmend-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def bounded(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, unless its user has set smaller ones, so that long rows don't meet by the thousand in a worker."""
    for name, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{name}"
        number, unit = re.match(r"(-?\d+)([kmg]?)", spark.conf.get(key).lower()).groups()
        if not 0 < int(number) << {"k": 10, "m": 20, "g": 30}.get(unit, 0) <= most:
            spark.conf.set(key, str(most))


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/texmend/{tag}-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete shuffle files of finished jobs; they would else stay until the driver's next collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: recovery starts here, not at the sources."""
    spark = df.sparkSession
    bounded(spark)
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    free_shuffles(spark)
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored() tables that nothing will read again."""
    for df in tables:
        spark, path = df.sparkSession, df._stored_at
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def unused(df: DataFrame, name: str) -> str:
    """name, with underscores behind it until df has no such column (Spark minds no case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
