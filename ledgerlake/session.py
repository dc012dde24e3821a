"""What the library asks of the caller's session: a shared folder and adaptive execution.

The library never builds a session. Jobs call `tune` once; operators that have to cut
lineage, and queries that have to write a table, ask here for the shared folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Adaptive execution is what splits a hot key on the big side of a join, so it must be on.
# forceOptimizeSkewedJoin keeps the split even where it costs a further exchange.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # rows for a few folders are written as they come, without a sort
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # a job is many writes: what one has exchanged is removed when it ends, not when the driver
    # happens to collect garbage; rows that are read again are exchanged again
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# A task's rows take many times their stored bytes in memory: a whole default split does not
# fit into the sort before an exchange and spills. A size that the cluster has set stays.
SPLIT_KEY = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 32 << 20
# Tables are written once and read a few times, and each layer keeps them: smaller files are
# worth their time. A codec that the cluster has set stays.
CODEC_KEY = "spark.sql.parquet.compression.codec"
CODEC = "zstd"


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the plans rely on; sizes stay as the cluster set them."""
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in ((SPLIT_KEY, str(SPLIT_BYTES)), (CODEC_KEY, CODEC)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in `spark.checkpoint.dir`."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="ledgerlake-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Store rows as a table in the shared folder and go on from there.

    Later steps then read the very same rows, also after executors are lost. A table is
    preferred to `checkpoint()`, as it is columnar and its size is known to the planner.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, folder: str, name: str = "rows") -> Iterator[DataFrame]:
    """Rows kept as a table below `folder` for the time of a block, and removed behind it."""
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
