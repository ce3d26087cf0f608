"""Days and marts replaced without a gap: new files are written whole, then names point to them.

A day table is a catalog table partitioned by day whose partitions may lie anywhere. A load writes
its days to a folder of its own; only then the catalog is told where the days are. A reader sees
each day as it was or as it is, never half of it, and a write that fails changes nothing. Marts of
one version are written side by side and become the published ones by a single small file.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlemill.sources.layers import DAY, write_layer
from candlemill.sources.warehouse import point_table

PUBLISHED = "_published"


def quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition(day: date) -> str:
    return f"PARTITION (year={day.year}, month={day.month}, day={day.day})"


def create_day_table(spark: SparkSession, table: str, schema: StructType, path: str) -> None:
    """An empty catalog table for rows of ``schema``, which has year, month and day, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(DAY)}) LOCATION {quoted(path)}"
    )


def write_days(df: DataFrame, path: str) -> str:
    """Write the rows by day to a new folder below ``path``, which no table reads yet."""
    folder = f"{path}/load={uuid.uuid4().hex}"
    write_layer(df, folder, DAY)
    return folder


def _days(df: DataFrame) -> list[date]:
    """Days of a table of days, no more than the directories of a layer."""
    return [date(*row) for row in df.select(*DAY).where("year IS NOT NULL").distinct().sort(*DAY).collect()]


def swap_days(spark: SparkSession, table: str, folder: str, days: DataFrame) -> None:
    """Let the table's ``days`` be those that ``write_days`` left in ``folder``.

    A day without files there has no rows any more and goes from the table. Days not named stay as
    they are. Running it again changes nothing.
    """
    schema = StructType([f for f in spark.table(table).schema if f.name in DAY])
    written = set(_days(spark.read.schema(schema).parquet(folder)))
    known = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for day in _days(days):
        where = f"year={day.year}/month={day.month}/day={day.day}"
        if day not in written:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition(day)}")
        elif where in known:
            spark.sql(f"ALTER TABLE {table} {_partition(day)} SET LOCATION {quoted(f'{folder}/{where}')}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_partition(day)} LOCATION {quoted(f'{folder}/{where}')}")
    spark.catalog.refreshTable(table)


def publish_marts(marts: dict[str, DataFrame], path: str, version: int) -> None:
    """Write marts as one version below ``path`` and publish all of them at once.

    Versions only grow. A run that fails before its end has published nothing; run again, it
    replaces what it wrote.
    """
    spark = next(iter(marts.values())).sparkSession
    for name, mart in marts.items():
        mart.write.mode("overwrite").parquet(f"{path}/{name}/version={version}")
    names = F.array(*[F.lit(n) for n in sorted(marts)])
    marker = spark.range(1).select(names.alias("marts"))
    marker.coalesce(1).write.mode("overwrite").parquet(f"{path}/{PUBLISHED}/version={version}")


def published_version(spark: SparkSession, path: str) -> int:
    """The newest version of which all marts are written."""
    return spark.read.parquet(f"{path}/{PUBLISHED}").agg(F.max("version").cast("bigint")).first()[0]


def read_marts(spark: SparkSession, path: str, *names: str) -> list[DataFrame]:
    """Published marts, all of the same version."""
    version = published_version(spark, path)
    return [spark.read.parquet(f"{path}/{name}/version={version}") for name in names]


def point_marts(spark: SparkSession, path: str, *names: str) -> None:
    """Let catalog tables of these names stand for the published version."""
    version = published_version(spark, path)
    for name in names:
        folder = f"{path}/{name}/version={version}"
        point_table(spark, name, spark.read.parquet(folder).schema, folder)
