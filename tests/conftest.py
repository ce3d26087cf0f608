from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from candlemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from a DDL schema and rows given as SQL-friendly values."""

    def build(schema: str, *rows: tuple):
        names = [part.split()[0] for part in schema.split(", ")]
        texts = ", ".join(f"{n} string" for n in names)
        raw = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], texts)
        return raw.selectExpr(
            *(f"cast({n} as {part.split(' ', 1)[1]}) as {n}" for n, part in zip(names, schema.split(", ")))
        )

    return build


def rows(df, *order: str) -> list[tuple]:
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
