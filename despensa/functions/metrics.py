"""Forecast error measures as aggregate expressions over (real, predicted)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def met_mae(y: Column | str, p: Column | str) -> Column:
    return F.avg(F.abs(_c(y) - _c(p)))


def met_rmse(y: Column | str, p: Column | str) -> Column:
    d = _c(y) - _c(p)
    return F.sqrt(F.avg(d * d))


def met_mape(y: Column | str, p: Column | str) -> Column:
    """Percent error over rows with a real value other than 0; 0 if there is none."""
    y, p = _c(y), _c(p)
    return F.coalesce(F.avg(F.when(y != 0, F.abs((y - p) / y))) * 100, F.lit(0.0))


def met_smape(y: Column | str, p: Column | str, por: float = 100.0) -> Column:
    """Symmetric error; ``por=1`` gives it as a fraction."""
    y, p = _c(y), _c(p)
    return F.avg(F.lit(2.0) * F.abs(y - p) / (F.abs(y) + F.abs(p) + F.lit(1e-8))) * F.lit(por)


def met_sesgo(y: Column | str, p: Column | str) -> Column:
    return F.avg(_c(p) - _c(y))


def met_activas(medida, y: Column | str, p: Column | str) -> Column:
    """Any measure above over weeks with sales only."""
    y = _c(y)
    return medida(F.when(y > 0, y), F.when(y > 0, _c(p)))


def met_mejora(y: Column | str, base: Column | str, hibrido: Column | str,
               mismas_filas: bool = False) -> Column:
    """Error of the baseline minus error of the hybrid.

    The published figure takes the hybrid over active weeks and the baseline over all of them;
    ``mismas_filas`` compares both over active weeks.
    """
    b = met_activas(met_mae, y, base) if mismas_filas else met_mae(y, base)
    return b - met_activas(met_mae, y, hibrido)
