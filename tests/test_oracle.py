"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from corpusloom.queries.oracle import ORACLE
from corpusloom.queries.spark import QUERIES
from tools.compare import oracle_rows, rows



def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_twin(spark, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    assert got
    names, _, data = oracle_rows(sf, ORACLE[name])
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, data)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
