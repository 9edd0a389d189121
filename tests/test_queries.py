"""Every registered query against its check SQL."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, base):
    assert compare(name, spark, base, SF_DIR, queries(), oracle_sql()) is None
