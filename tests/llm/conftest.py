"""Small sessions and tables for the operators of training data."""

from __future__ import annotations

import os

import pytest
from llm_cases import DOCUMENTS
from pyspark.sql import SparkSession

SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark: SparkSession):
    """Nulls in any column, empty and very long texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30000))
    rows = [
        (1, "", "en", "a", 0),
        (2, None, None, None, None),
        (3, long, "en", "a", len(long)),
        (4, long, None, "a", len(long)),
        (5, " \t\n ", "en", None, 4),
        (6, "ein wörd 中文   x", "de", "b", 15),
        (7, "same words here", "en", "b", 15),
        (7, "same words here", "en", "b", 15),
        (None, "no number", "en", "b", 9),
    ]
    extra = ", key int, start int, mark string, n int, size string, block int, score double, least int"
    return spark.createDataFrame([(*r, 1, 2, "m", 3, "s", 4, 0.5, 6) for r in rows], DOCUMENTS + extra)
