"""Product segmentation: quadrants on medians, Pareto ABC, critical products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despensa.operators.filters import flt_local_fecha
from despensa.soporte import acumular, cortar, percentiles_exactos, sin_nulos

# The names of the quadrants.
ESTRELLA = "ESTRELLA (Alto Vol / Alto $)"
PREMIUM = "PREMIUM (Bajo Vol / Alto $)"
GANCHO = "GANCHO (Alto Vol / Bajo $)"
BAJO = "BAJO DESEMPEÑO"


def agg_producto(ventas: DataFrame) -> DataFrame:
    """Per product: lines, units, revenue and mean price weighted by units."""
    return (
        sin_nulos(ventas, "Nombre").groupBy("Nombre")
        .agg(F.count("Cantidad").alias("transacciones"),
             F.sum("Cantidad").alias("cantidad_total"),
             F.sum("Total").alias("plata_generada"))
        .withColumn("precio_promedio", F.try_divide("plata_generada", "cantidad_total"))
    )


def agg_bcg(info: DataFrame) -> DataFrame:
    """Quadrant of each product, cut at the exact medians of units and revenue.

    ``info`` is read several times; pass a stored table (``cortar``) when it comes from a ledger.
    """
    x, y = percentiles_exactos(info, ["cantidad_total", "plata_generada"], 0.5)
    volumen, plata = F.col("cantidad_total") >= F.lit(x), F.col("plata_generada") >= F.lit(y)
    return info.withColumn(
        "Categoria_Matriz",
        F.when(volumen & plata, ESTRELLA).when(~volumen & plata, PREMIUM)
        .when(volumen & ~plata, GANCHO).otherwise(BAJO),
    )


def win_pareto(info: DataFrame, metrica: str, nombre: str = "Nombre", pct: str = "pct",
               acum: str = "pct_acum", rango: str = "rango") -> DataFrame:
    """Share and running share of each product, largest first, with its rank."""
    return (
        acumular(info, metrica, nombre, "_a", rango, "_t")
        .withColumn(pct, F.try_divide(F.col(metrica), F.col("_t")))
        .withColumn(acum, F.try_divide(F.col("_a"), F.col("_t")))
        .drop("_a", "_t")
    )


def win_abc(pareto: DataFrame, pct: str = "pct", acum: str = "pct_acum", clase: str = "Clase_ABC",
            regla: str = "cruce", a: float = 0.80, b: float = 0.95) -> DataFrame:
    """A, B or C by running share.

    ``exclusiva`` leaves out the product that crosses the bound, ``cruce`` keeps it in.
    """
    antes = F.col(acum) if regla == "exclusiva" else F.col(acum) - F.col(pct)

    def dentro(lim: float):
        return antes <= lim if regla == "exclusiva" else antes < lim

    return pareto.withColumn(clase, F.when(dentro(a), "A").when(dentro(b), "B").otherwise("C"))


def win_n80(pareto: DataFrame, acum: str = "pct_acum", corte: float = 0.80) -> DataFrame:
    """How many products make 80 % of revenue, the crossing one counted."""
    return pareto.agg((F.count_if(F.col(acum) <= corte) + 1).alias("n80"))


def set_interseccion(info_estrella: DataFrame, regla: str = "cruce") -> DataFrame:
    """Products of class A by money and by number of sales, with their figures."""
    dinero = win_abc(win_pareto(info_estrella, "plata_generada"), regla=regla) \
        .filter("Clase_ABC = 'A'")
    ventas = win_abc(win_pareto(info_estrella, "transacciones"), regla=regla) \
        .filter("Clase_ABC = 'A'").select("Nombre")
    return dinero.join(ventas, "Nombre", "left_semi").drop("rango", "Clase_ABC")


def productos_criticos(ventas: DataFrame, local: str = "Principal", desde: str = "2024-01-01",
                       regla: str = "cruce") -> DataFrame:
    """Ledger to critical products. One pass over the ledger: the product totals are stored and
    every later step works on them."""
    info = cortar(agg_producto(flt_local_fecha(ventas, local, desde)))
    estrella = agg_bcg(info).filter(F.col("Categoria_Matriz") == ESTRELLA)
    return set_interseccion(estrella, regla)
