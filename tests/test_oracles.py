"""Every query against its SQL, and the driver's contract."""

import os
import re

import pytest

import __spark_entry__ as entry

from .compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_of_the_library_has_its_sql():
    optional = {name for name in entry.queries() if name == "pipeline" or re.match(r"op\d+_", name)}
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry.queries().keys() - optional <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "n_articles", "n_words"] and df.count() > 0
