"""Registry of the named queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa.plans.bindings import Tablas, con

CONSULTAS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def consulta(clave: str, sql: str | None = None, dobles: str = ""):
    """Registers ``f(tablas) -> DataFrame`` under an operator id.

    ``dobles`` names the double columns reported with 4 places (``name:6`` for 6), in both
    results: the last bits of a sum depend on the order its terms arrive in.
    """
    lugares = {}
    for d in dobles.split():
        nombre, _, n = d.partition(":")
        lugares[nombre] = int(n or 4)

    def poner(f: Callable[[Tablas], DataFrame]):
        def correr(spark: SparkSession, ruta: str) -> DataFrame:
            df = f(Tablas(spark, ruta))
            return df.withColumns({c: F.round(F.col(f"`{c}`"), n) for c, n in lugares.items()})

        if clave in CONSULTAS:
            raise ValueError(f"{clave} is registered twice")
        CONSULTAS[clave] = correr
        if sql is not None:
            texto = con(sql)
            if lugares:
                cambios = ", ".join(f'round("{c}", {n}) AS "{c}"' for c, n in lugares.items())
                texto = f"SELECT * REPLACE ({cambios}) FROM (\n{texto}\n) r"
            SQL[clave] = texto
        return f

    return poner
