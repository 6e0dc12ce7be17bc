"""Every query that has an SQL form gives the rows DuckDB gives."""

import __spark_entry__ as entrada
import pytest
from comparar import comparar, conexion

Q, S = entrada.queries(), entrada.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return conexion(sf)


@pytest.mark.parametrize("clave", sorted(S))
def test_igual_que_sql(spark, duck, sf, clave):
    ok, nota, _ = comparar(spark, duck, clave, Q[clave], S[clave], sf)
    assert ok, nota


def test_entrada(spark):
    assert entrada.entry(spark).count() > 0


def test_sql_solo_de_consultas():
    assert set(S) <= set(Q)
