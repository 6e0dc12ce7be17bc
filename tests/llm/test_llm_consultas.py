"""Every query of the subpackage that has an SQL form gives the rows DuckDB gives; all run."""

import pytest
from comparar import comparar, conexion

from despensa.llm import queries


@pytest.fixture(scope="module")
def duck(sf):
    return conexion(sf)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_as_sql(spark, duck, sf, name):
    ok, note, _ = comparar(spark, duck, name, queries.CONSULTAS[name], queries.SQL[name], sf)
    assert ok, note


def test_one_query_for_each_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.CONSULTAS)
    assert numbers == list(range(1, 14))
