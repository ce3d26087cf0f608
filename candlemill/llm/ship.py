"""Make the package importable in Python workers."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import candlemill

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 1_000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors of this application, once.

    Whole texts are long rows, so Arrow batches of this session get fewer of them: batches bound
    the memory of a worker and of the buffers outside the heap.
    """
    if int(spark.conf.get(BATCH_ROWS, "10000")) > ROWS:
        spark.conf.set(BATCH_ROWS, str(ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(candlemill.__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="candlemill-"), "candlemill.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, which first ships the package; its first argument is the session."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest):
        ship(spark)
        return query(spark, *rest)

    return run
