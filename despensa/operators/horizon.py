"""Forecast bands, confidence and model choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percentil80(error: Column | str, minimo: int = 3) -> Column:
    """80th percentile of absolute errors, null below ``minimo`` of them.

    For use per product and step: such a group holds one value per back-test week.
    """
    e = _c(error)
    return F.when(F.count(e) >= minimo, F.percentile(e, F.lit(0.8)))


def ts_confianza(h: Column | str) -> Column:
    """80 % at the first week, 7 points less each further week, never below 50."""
    return F.greatest(F.lit(50), F.lit(80) - (_c(h) - 1) * 7).cast("int")


def ts_intervalo(df: DataFrame, h: str = "semana_offset") -> DataFrame:
    """Band around each forecast: calibrated width, or the residual spread grown by 15 % a week
    where there is no (or a zero) calibrated width."""
    respaldo = F.col("std_residual") * (1 + F.lit(0.15) * (F.col(h) - 1))
    ancho = F.coalesce(F.nullif(F.col("p80"), F.lit(0.0)), respaldo)
    return df.withColumns({
        "prediccion_lower": F.greatest(F.lit(0.0), F.col("prediccion") - ancho),
        "prediccion_upper": F.col("prediccion") + ancho,
    })


def ts_seleccion(df: DataFrame, hibrido: str, base: str, completas: Column | None = None
                 ) -> DataFrame:
    """The hybrid only where its error is lower and its inputs are complete."""
    gana = F.col("mae_hibrido") < F.col("mae_base")
    if completas is not None:
        gana = gana & completas
    gana = F.coalesce(gana, F.lit(False))
    return df.withColumns({
        "elegida": F.when(gana, F.col(hibrido)).otherwise(F.col(base)),
        "modelo": F.when(gana, "hibrido").otherwise("base"),
    })
