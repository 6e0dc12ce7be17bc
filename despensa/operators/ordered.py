"""Fills along a row order, without gathering a whole file in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _llenar(df: DataFrame, valor: Column, grupo: list[str], orden: str, tramo: Column,
            salida: str, adelante: bool) -> DataFrame:
    """Nearest non-null value at or after (``adelante``) or at or before each row.

    Rows are cut into stretches in row order. Each stretch is filled by itself; what it lacks comes
    from the nearest stretch that has a value, found on a table of one row per stretch.
    """
    d = df.withColumns({"_v": valor, "_t": tramo})
    # Rows above the current one, downwards or upwards: a frame that only grows costs one step a row. One
    # that reaches from the row to the end is read anew for every row.
    sentido = (lambda c: F.col(c).desc()) if adelante else (lambda c: F.col(c).asc())
    dentro = (Window.partitionBy(*grupo, "_t").orderBy(sentido(orden))
              .rowsBetween(Window.unboundedPreceding, 0))
    borde = F.min_by if adelante else F.max_by
    resumen = d.groupBy(*grupo, "_t").agg(
        borde("_v", F.when(F.col("_v").isNotNull(), F.col(orden))).alias("_b"))
    otros = Window.partitionBy(*grupo).orderBy(sentido("_t")).rowsBetween(Window.unboundedPreceding, -1)
    resumen = resumen.withColumn("_b", F.last("_b", ignorenulls=True).over(otros))
    d = d.withColumn("_v", F.last("_v", ignorenulls=True).over(dentro))
    return (d.join(resumen, [*grupo, "_t"], "left")
            .withColumn(salida, F.coalesce("_v", "_b")).drop("_v", "_t", "_b"))


def win_bfill(df: DataFrame, col: str, grupo: list[str], orden: str,
              tramo: Column | None = None) -> DataFrame:
    """Null values take the next one below, inside a file or an invoice."""
    t = F.floor(F.col(orden) / 100_000) if tramo is None else tramo
    return _llenar(df, F.col(col), grupo, orden, t, col, True)


def win_ffill(df: DataFrame, valor: Column, salida: str, grupo: list[str], orden: str,
              tramo: Column | None = None) -> DataFrame:
    """A value is carried down until the next one."""
    t = F.floor(F.col(orden) / 100_000) if tramo is None else tramo
    return _llenar(df, valor, grupo, orden, t, salida, False)
