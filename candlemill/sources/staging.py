"""Intermediates written once to the shared folder and read back."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one below the warehouse.

    Both are folders that the driver and all executors reach. On a cluster a folder of one
    machine (``file:`` without the setting, or a bare path there) is not: the checkpoint folder
    has to be named, so a session on a cluster without it is refused.
    """
    folder = spark.sparkContext.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_staged"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """``df`` written as parquet and read back: computed once, and safe from lost executors.

    The files stay until ``drop_staged`` or as long as the shared folder keeps them.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query has shuffled is removed at its end, not when the driver collects its garbage.

    For plans of many staged steps. A frame made in it and run twice would shuffle twice, so its
    results have to be staged.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_staged(df: DataFrame) -> None:
    """Remove the staged folders that ``df`` reads, once its result is written."""
    spark = df.sparkSession
    root = shared_folder(spark)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    base = base.getFileSystem(conf).makeQualified(base)
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        if fs.makeQualified(path).getParent().equals(base):
            fs.delete(path, True)
