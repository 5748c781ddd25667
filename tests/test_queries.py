"""Every registered query against its DuckDB SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.catalogue import QUERIES
from checks.oracles import ORACLES

from .verify_oracles import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) is None


def test_entry(spark):
    assert entry(spark).count() > 0
