"""Every registered query gives what its SQL twin gives, value for value."""

import pytest

import __spark_entry__ as registry
from twins import duck_rows, duck_types, spark_rows, spark_types

from conftest import TESTDATA

OWN = {query.__name__ for query in registry.QUERIES}
QUERIES = {name: query for name, query in registry.queries().items() if name in OWN}
ORACLES = registry.oracle_sql()


def test_every_query_has_a_twin():
    assert OWN <= set(ORACLES)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name, scale):
    connection = duck(scale)
    frame = QUERIES[name](spark, f"{TESTDATA}/{scale}")
    names, rows = spark_rows(frame)
    expected_names, expected = duck_rows(connection, ORACLES[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected
    assert spark_types(frame) == duck_types(connection, ORACLES[name])


def test_flagship(spark):
    assert registry.entry(spark).count() > 0
