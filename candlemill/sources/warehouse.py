"""Warehouse tables: JDBC and Spark's own catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def jdbc_options(
    url: str,
    table: str,
    connections: int = 8,
    batch_rows: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Writer options. ``truncate`` keeps the table's declared types when it is replaced."""
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        "truncate": "true",
        **connection,
    }


def read_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    connections: int = 8,
    **connection: str,
) -> dict[str, str]:
    """Reader options. With a numeric, date or timestamp ``column`` the scan is split by ranges
    of it; the bounds set the stride and leave no row out."""
    options = {"url": url, "dbtable": table, **connection}
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a split scan needs both bounds")
        options |= {
            "partitionColumn": column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(connections),
        }
    return options


def write_warehouse(df: DataFrame, url: str, table: str, mode: str = "overwrite", **choices) -> None:
    """Replace (or append to) a database table over parallel connections.

    A lost executor may repeat a committed part. Load into a scratch table and swap where that
    matters.
    """
    df.write.format("jdbc").options(**jdbc_options(url, table, **choices)).mode(mode).save()


def read_warehouse(spark: SparkSession, url: str, table: str, **choices) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **choices)).load()


def write_mart(df: DataFrame, table: str, path: str | None = None) -> None:
    """Rebuild a mart as a catalog table, at ``path`` if given."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def point_table(spark: SparkSession, table: str, schema: StructType, path: str) -> None:
    """Make a catalog table stand for the parquet files at ``path``.

    The change is one entry of the catalog: readers see the old files or the new ones, never none.
    """
    if spark.catalog.tableExists(table):
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{where}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path, "parquet", schema)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
