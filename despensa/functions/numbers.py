"""Number and null coercions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cln_numero(c: Column | str) -> Column:
    """Text to number; what does not parse counts as 0."""
    return F.coalesce(_c(c).try_cast("double"), F.lit(0.0))


def cln_total(total: Column | str, cantidad: Column | str, precio: Column | str,
              por_defecto: str = "producto") -> Column:
    """Missing line total: quantity times price in the batch job, 0 in the panel."""
    t = _c(total).try_cast("double")
    if por_defecto == "cero":
        return F.coalesce(t, F.lit(0.0))
    return F.coalesce(t, _c(cantidad) * _c(precio))


def cln_moneda(c: Column | str) -> Column:
    """``$1.234,56`` to 1234.56; null and blank to 0."""
    sin = F.trim(F.replace(F.replace(F.replace(_c(c), F.lit("$"), F.lit("")), F.lit("."),
                                     F.lit("")), F.lit(","), F.lit(".")))
    return F.coalesce(F.nullif(sin, F.lit("")).try_cast("double"), F.lit(0.0))


def num_recorte(c: Column | str) -> Column:
    """Forecast units: never negative, rounded up."""
    return F.ceil(F.greatest(_c(c), F.lit(0.0)))


def _mitades(x: float) -> tuple[float, float]:
    """Upper and lower half of a number's digits, for exact products."""
    a = 134217729.0 * x
    alto = a - (a - x)
    return alto, x - alto


def num_redondeo(c: Column | str, n: int = 0) -> Column:
    """Half-even rounding of the exact binary value: 0.15, a little below its text, gives 0.1.

    The value is scaled with an exact product, number and error term, so only true halves are
    ties. Values too large to have such places stay as they are.
    """
    x, s = _c(c).cast("double"), 10.0 ** n
    a = x * F.lit(134217729.0)
    xa = a - (a - x)
    xb = x - xa
    sa, sb = (F.lit(v) for v in _mitades(s))
    p = x * F.lit(s)
    error = ((xa * sa - p) + xa * sb + xb * sa) + xb * sb
    k = F.floor(p).cast("double")
    d = (p - k - F.lit(0.5)) + error
    sube = (d > 0) | ((d == 0) & (F.pmod(k, F.lit(2.0)) == 1))
    redondo = (k + F.when(sube, 1.0).otherwise(0.0)) / F.lit(s)
    return F.when(F.abs(x) < F.lit(2.0 ** 52 / s), redondo).otherwise(x)


def num_escala(c: Column | str, divisor: float) -> Column:
    return _c(c) / F.lit(float(divisor))


def num_participacion(parte: Column | str, todo: Column | str, por: float = 100.0) -> Column:
    """Share of a total; a zero total gives null."""
    return F.try_divide(_c(parte), F.nullif(_c(todo), F.lit(0))) * F.lit(por)


def cat_confianza(c: Column | str) -> Column:
    """Confidence tier of a forecast week."""
    return F.when(_c(c) >= 70, "alta").when(_c(c) >= 50, "media").otherwise("baja")
