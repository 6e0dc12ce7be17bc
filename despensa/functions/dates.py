"""Date parsing, periods and calendar parts as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- fixed values: formats of the sources, and the days nanosecond timestamps can hold ----
ISO = ("yyyy-M-d",)
DIA_PRIMERO = ("d/M/yyyy", "yyyy-M-d")
PRIMER_DIA, ULTIMO_DIA = "1677-09-22", "2262-04-11"
# -------------------------------------------------------------------------------------------


def cln_fecha(c: Column | str, formatos: tuple[str, ...] = ISO) -> Column:
    """Text to date by the first format that fits, else null.

    Days and months may lack their leading zero. A day outside the range above is null: one mistyped
    year would stretch every calendar taken from the first and last date.
    """
    # A date may carry a time of day after it; only the day counts.
    dia = F.regexp_extract(_c(c), r"^\s*(\S+)", 1)
    dia = F.regexp_replace(dia, r"T.*$", "")
    fecha = F.coalesce(*[F.try_to_timestamp(dia, F.lit(f)).cast("date") for f in formatos])
    return F.when(fecha.between(F.lit(PRIMER_DIA).cast("date"), F.lit(ULTIMO_DIA).cast("date")), fecha)


def fec_lunes(c: Column | str) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", _c(c)).cast("date")


def fec_periodos(c: Column | str) -> dict[str, Column]:
    """Month, week start and day as text, weekday name and year."""
    d = _c(c)
    return {
        "Mes": F.date_format(d, "yyyy-MM"),
        "Semana": F.date_format(fec_lunes(d), "yyyy-MM-dd"),
        "Dia": F.date_format(d, "yyyy-MM-dd"),
        "DiaSemana": F.date_format(d, "EEEE"),
        "Anio": F.year(d),
    }


def fec_calendario(c: Column | str) -> dict[str, Column]:
    """Month, ISO week, quarter, half-year."""
    d = _c(c)
    return {
        "mes": F.month(d),
        "semana_anio": F.weekofyear(d),
        "trimestre": F.quarter(d),
        "semestre": F.when(F.quarter(d) <= 2, 1).otherwise(2),
    }


def fec_ciclicas(c: Column | str) -> dict[str, Column]:
    """Sine and cosine of the month (12) and of the ISO week (52)."""
    d = _c(c)
    vuelta = F.lit(2 * math.pi)
    m, s = vuelta * F.month(d) / 12, vuelta * F.weekofyear(d) / 52
    return {"mes_sin": F.sin(m), "mes_cos": F.cos(m), "semana_sin": F.sin(s),
            "semana_cos": F.cos(s)}


def fec_antes_verano(c: Column | str, verano: Column) -> Column:
    """Weeks into the four before the first summer break: 1..4, else 0."""
    dias = F.datediff(verano, _c(c))
    return F.when(dias > 0, F.greatest(F.lit(0), F.lit(4) - F.floor(dias / 7))).otherwise(0) \
        .cast("int")


def fec_marcas(semana: Column | str) -> dict[str, Column]:
    """Mid-term and back-to-class flags of an academic week."""
    s = _c(semana)
    return {
        "inicio_parciales_1": (s == 7).cast("int"),
        "fin_parciales_1": (s == 8).cast("int"),
        "inicio_parciales_2": (s == 12).cast("int"),
        "fin_parciales_2": (s == 13).cast("int"),
        "vuelta_a_clases": s.isin(1, 2).cast("int"),
    }


def fec_interaccion(lag1: Column | str, marca: Column | str) -> Column:
    return _c(lag1) * _c(marca)
