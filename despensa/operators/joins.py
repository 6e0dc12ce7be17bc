"""Joins of the ledger with its dimensions and with itself over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jn_catalogo(ventas: DataFrame, catalogo: DataFrame) -> DataFrame:
    """Catalogue quadrant of each line, with a default. No broadcast is forced: the catalogue grows
    with the number of products, so its size decides at run time."""
    return (ventas.join(catalogo.select("Nombre", "Categoria"), "Nombre", "left")
            .withColumn("Categoria", F.coalesce("Categoria", F.lit("Sin categoria"))))


def jn_dedup(nuevo: DataFrame, existente: DataFrame, id: str = "Consecutivo") -> DataFrame:
    """New rows whose invoice is not stored yet. Repeats inside ``nuevo`` are lines of one invoice
    and stay.

    The stored side is first cut down to the invoices of the batch. As long as the batch's invoice
    numbers fit the broadcast threshold that cut is a filter over a one-column scan; a larger batch
    shuffles the stored invoice numbers, that column alone.
    """
    lote = nuevo.select(id).distinct()
    vistos = existente.select(id).join(lote, id, "left_semi").distinct()
    return nuevo.join(vistos, id, "left_anti")


def set_union(*partes: DataFrame) -> DataFrame:
    total = partes[0]
    for p in partes[1:]:
        total = total.unionByName(p)
    return total


def set_union_tag(partes: dict[str, DataFrame], col: str = "Lugar") -> DataFrame:
    """Union that keeps which part each row came from."""
    return set_union(*[df.withColumn(col, F.lit(t)) for t, df in partes.items()])
