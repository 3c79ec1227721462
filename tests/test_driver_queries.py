"""All queries against their SQL, at the smallest scale."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, tables, name):
    assert difference(spark, tables, name, SF) == ""


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["public_tokenizers", "tallywing.llm", "corpus_pipeline"])
def test_queries_are_there_without_the_optional_part(missing):
    """A library that cannot be imported takes the optional queries with it, and only those."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as d; print(*d.queries())"
    root = os.path.dirname(os.path.abspath(driver.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert set(done.stdout.split()) == set(QUERIES)
