"""Stored days of the panel: sums and mergeable exact counts of distinct invoices.

A panel's date filter asks for any stretch of days. Sums of days add up; distinct invoices don't, for
an invoice may have lines on several days. Here every invoice has a number and a day keeps, for each
value of a dimension, the bitmaps of its invoices' numbers: those of several days are merged by OR,
so any stretch is answered from the stored days, exactly and without reading the ledger.

Numbers follow the day an invoice is first seen on, so the invoices of a day lie beside each other
and a day has few bitmaps (of 32,768 invoices each). A bitmap is a list of those of its words of 64
invoices that hold any: an invoice whose lines are spread over many days costs a word on each of them,
not a bitmap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despensa.soporte import acumular, cortar

CUBO = 32_768
PALABRA = 64


def numerar(ventas: DataFrame, desde: int = 0) -> DataFrame:
    """(Consecutivo, numero): a number for every invoice, in the order of their first day. New
    invoices of a later batch go on from ``desde``, the count of those that have one."""
    primeras = ventas.filter(F.col("Consecutivo").isNotNull()).groupBy("Consecutivo").agg(
        F.min(F.unix_date("Fecha")).alias("_d")).withColumn("_d", -F.coalesce("_d", F.lit(0)))
    return acumular(primeras, "_d", "Consecutivo").select(
        "Consecutivo", (F.col("pos") - 1 + desde).alias("numero"))


def agg_recuento(ventas: DataFrame, numeros: DataFrame, *dims: str) -> DataFrame:
    """Stored days: Fecha, ``dims``, cubo, bits, and Ingresos, Unidades and Lineas beside the first bitmap.

    Lines without an invoice count in the sums and have no bit. One row for each day, value and bitmap;
    partial ORs before the shuffle, so a hot day or value arrives as one row for each word from each task.
    """
    en_cubo = F.pmod("numero", F.lit(CUBO))
    palabras = (
        ventas.join(numeros, "Consecutivo").groupBy(
            "Fecha", *dims, F.floor(F.col("numero") / CUBO).alias("cubo"), F.floor(en_cubo / PALABRA).alias("p"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(pmod(numero, {CUBO}), {PALABRA}) AS INT))")).alias("b"))
    )
    bits = palabras.groupBy("Fecha", *dims, "cubo").agg(F.collect_list(F.struct("p", "b")).alias("bits"))
    sumas = ventas.groupBy("Fecha", *dims).agg(
        F.sum("Total").alias("Ingresos"), F.sum("Cantidad").alias("Unidades"), F.count(F.lit(1)).alias("Lineas"),
    ).withColumns({"cubo": F.lit(None).cast("bigint"), "bits": F.lit(None).cast(bits.schema["bits"].dataType)})
    return sumas.unionByName(bits, allowMissingColumns=True)


def recuento(dias: DataFrame, *dims: Column | str, desde: dt.date | str | None = None,
             hasta: dt.date | str | None = None) -> DataFrame:
    """Ingresos, Unidades, Lineas and Facturas of the stored days between two dates (both kept in), for each
    value of ``dims``: columns of the stored table or expressions over them, a weekday, say."""
    d = dias
    if desde is not None:
        d = d.filter(F.col("Fecha") >= F.lit(desde))
    if hasta is not None:
        d = d.filter(F.col("Fecha") <= F.lit(hasta))
    por = [F.col(c) if isinstance(c, str) else c for c in dims]
    # First the words of a value that cover the same invoices, then their counts: both are summed before
    # they move.
    juntos = d.select(
        *por, "cubo", "Ingresos", "Unidades", "Lineas", F.explode_outer("bits").alias("_w")).select(
        "*", F.col("_w.p").alias("_p"), F.col("_w.b").alias("_b")).drop("_w")
    nombres = juntos.columns[:len(por)]
    claves = [F.col(f"`{c}`") for c in nombres]
    juntos = juntos.groupBy(*claves, "cubo", "_p").agg(
        F.bit_or("_b").alias("_b"), F.sum("Ingresos").alias("_i"), F.sum("Unidades").alias("_u"),
        F.sum("Lineas").alias("_n"))
    return juntos.groupBy(*claves).agg(
        F.sum("_i").alias("Ingresos"), F.sum("_u").alias("Unidades"), F.sum("_n").alias("Lineas"),
        F.coalesce(F.sum(F.bit_count("_b").cast("bigint")), F.lit(0)).alias("Facturas"))


def agg_recuento_nuevo(dias: DataFrame, numeros: DataFrame, ventas: DataFrame, *dims: str) -> tuple[DataFrame, DataFrame]:
    """Stored days and numbers with a further batch of the ledger in them: only the batch is read, what is
    stored stays as it is. An invoice that has a number keeps it."""
    nuevas = ventas.join(numeros.select("Consecutivo"), "Consecutivo", "left_anti")
    todos = cortar(numeros.unionByName(numerar(nuevas, numeros.count())))
    return cortar(dias.unionByName(agg_recuento(ventas, todos, *dims))), todos
