"""Autocorrelation diagnostics of every series at once."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from despensa.soporte import enviar_por_valor

enviar_por_valor(__name__)

Z95 = 1.959963984540054


def _autocorrelaciones(df: DataFrame, y: str, rezagos: int) -> DataFrame:
    """Per product: n and the array r_1..r_K. One shuffle by product serves lags and sums."""
    w = Window.partitionBy("producto").orderBy("ds")
    todo = Window.partitionBy("producto")
    d = df.filter(F.col(y).isNotNull()).select(
        "producto", "ds", (F.col(y) - F.avg(y).over(todo)).alias("d"))
    d = d.select("producto", "d", *[F.lag("d", k).over(w).alias(f"d{k}")
                                    for k in range(1, rezagos + 1)])
    s0 = F.sum(F.col("d") * F.col("d"))
    return d.groupBy("producto").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.try_divide(F.coalesce(F.sum(F.col("d") * F.col(f"d{k}")), F.lit(0.0)), s0)
                  for k in range(1, rezagos + 1)]).alias("r"))


def st_acf(df: DataFrame, y: str = "y", rezagos: int = 20) -> DataFrame:
    """Autocorrelation of lags 0..K with its 95 % band (variance grows with earlier lags)."""
    a = _autocorrelaciones(df, y, rezagos).select(
        "producto", "n", F.posexplode(F.concat(F.array(F.lit(1.0)), "r")).alias("lag", "acf")
    ).filter(F.col("lag") < F.col("n"))  # a series of n weeks has lags up to n - 1
    previas = (Window.partitionBy("producto").orderBy("lag")
               .rowsBetween(Window.unboundedPreceding, -1))
    suma = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(previas),
                      F.lit(0.0))
    banda = F.when(F.col("lag") == 0, 0.0).otherwise(
        F.lit(Z95) * F.sqrt((1 + 2 * suma) / F.col("n")))
    return a.withColumn("banda", banda).drop("n")


def st_pacf(df: DataFrame, y: str = "y", rezagos: int = 20) -> DataFrame:
    """Partial autocorrelation by Durbin-Levinson on the biased ACF, with its 95 % band.

    The recursion runs as an array fold inside the JVM; each product is one short array.
    """
    r = F.col("r")

    def paso(acc, k):
        previas = F.reverse(F.slice(r, 1, k - 1))
        num = F.element_at(r, k) - F.aggregate(
            F.zip_with(acc["phi"], previas, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        f = F.try_divide(num, acc["v"])
        phi = F.concat(F.zip_with(acc["phi"], F.reverse(acc["phi"]), lambda a, b: a - f * b),
                       F.array(f))
        return F.struct(phi.alias("phi"), (acc["v"] * (1 - f * f)).alias("v"),
                        F.concat(acc["p"], F.array(f)).alias("p"))

    vacio = F.array().cast("array<double>")
    inicio = F.struct(vacio.alias("phi"), F.lit(1.0).alias("v"), vacio.alias("p"))
    ks = F.sequence(F.lit(1), F.lit(rezagos))
    return _autocorrelaciones(df, y, rezagos).select(
        "producto", "n", F.aggregate(ks, inicio, paso, lambda a: a["p"]).alias("p")
    ).select(
        "producto", "n", F.posexplode(F.concat(F.array(F.lit(1.0)), "p")).alias("lag", "pacf"),
        (F.lit(Z95) / F.sqrt("n")).alias("banda")).filter(F.col("lag") < F.col("n")).drop("n")


def _erfc(z: np.ndarray) -> np.ndarray:
    """Complementary error function of numbers not below 0: a series of positive terms up to 2.5,
    a continued fraction beyond."""
    chica = np.minimum(z, 2.5)
    termino = suma = chica
    for k in range(1, 60):
        termino = termino * 2 * chica * chica / (2 * k + 1)
        suma = suma + termino
    cerca = 1 - 2 / math.sqrt(math.pi) * np.exp(-chica * chica) * suma
    grande = np.maximum(z, 2.5)
    f = grande
    for k in range(60, 0, -1):
        f = grande + k / 2 / f
    return np.where(z <= 2.5, cerca, np.exp(-grande * grande) / f / math.sqrt(math.pi))


def cola_chi2(x, gl: int):
    """Upper tail of a chi-square with whole degrees of freedom, in closed form, for all values of
    ``x`` at once; the loops run over the degrees of freedom only."""
    h = np.maximum(np.asarray(x, float), 0.0) / 2.0
    if gl % 2 == 0:
        termino = suma = np.ones_like(h)
        for i in range(1, gl // 2):
            termino = termino * h / i
            suma = suma + termino
        return np.exp(-h) * suma
    termino, suma = np.sqrt(h) / math.gamma(1.5), np.zeros_like(h)
    for i in range(1, (gl + 1) // 2):
        suma = suma + termino
        termino = termino * h / (i + 0.5)
    return _erfc(np.sqrt(h)) + np.exp(-h) * suma


def st_ljung(df: DataFrame, y: str = "residuo", rezagos: int = 15) -> DataFrame:
    """Ljung-Box statistic, p-value and verdict for every lag up to K.

    As in the source, K is 15 or half the series less one, whichever is smaller.
    """
    @F.pandas_udf("double")
    def cola(q: pd.Series, gl: pd.Series) -> pd.Series:
        p, x, k = np.full(len(q), np.nan), q.to_numpy("float64"), gl.to_numpy()
        for b in np.unique(k):  # one turn for each lag
            p[k == b] = cola_chi2(x[k == b], int(b))
        return pd.Series(p).where(q.notna().to_numpy())

    a = _autocorrelaciones(df, y, rezagos).select(
        "producto", "n", F.posexplode("r").alias("pos", "r")
    ).withColumn("lag", F.col("pos") + 1)
    a = a.filter(F.col("lag") <= F.floor(F.col("n") / 2) - 1)
    w = (Window.partitionBy("producto").orderBy("lag")
         .rowsBetween(Window.unboundedPreceding, 0))
    n = F.col("n").cast("double")
    q = n * (n + 2) * F.sum(F.col("r") * F.col("r") / (n - F.col("lag"))).over(w)
    return (a.withColumn("estadistico", q).withColumn("p_valor", cola("estadistico", "lag"))
            .select("producto", "lag", "estadistico", "p_valor",
                    (F.col("p_valor") < 0.05).alias("significativo")))


def st_ljung_resumen(lb: DataFrame) -> DataFrame:
    """How many lags are significant, and which."""
    return lb.groupBy("producto").agg(
        F.count_if("significativo").alias("n_sig"), F.count(F.lit(1)).alias("n_lags"),
        F.sort_array(F.collect_list(F.when(F.col("significativo"), F.col("lag")))).alias("lags"))
