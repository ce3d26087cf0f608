"""Every registered query against its SQL."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry
from candlemill.plans.oracle import ORACLE
from candlemill.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    assert compare(got, duck.execute(ORACLE[name]).df()) is None


def test_entry(spark):
    assert entry(spark).columns[:2] == ["candle_start_time", "symbol"]


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_file_without_the_corpus_operators(tmp_path, gone):
    """The entry file imports where the subpackage is deleted, with or without the pipeline."""
    root = Path(__file__).resolve().parents[1]
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(*gone, ".git", "__pycache__", "*.json"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(ORACLE)), "False"], said.stderr
