"""Session settings the layers rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str, master: str | None = None, **conf: object) -> SparkSession:
    """Session in UTC with adaptive execution. The master is left to spark-submit unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """Sibling session for streaming queries, so that their settings do not leak into batch work.

    State lives in RocksDB, off the executor heap. ``state_partitions`` is fixed by the first run
    of a query and kept in its checkpoint, so choose it for the expected peak, not for today.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    # Splits the large partitions of a stateless query's output.
    session.conf.set("spark.sql.adaptive.enabled", "true")
    session.conf.set("spark.sql.adaptive.streaming.stateless.enabled", "true")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10000")
    session.conf.set(
        "spark.sql.shuffle.partitions",
        str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions")),
    )
    return session
