"""Fields of a nested invoice document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def anid_impuesto(taxes: Column) -> Column:
    """Sum of the tax values of a line, nulls as 0."""
    valores = F.coalesce(F.transform(taxes, lambda t: F.coalesce(t["value"], F.lit(0.0))),
                         F.array().cast("array<double>"))
    return F.aggregate(valores, F.lit(0.0), lambda a, v: a + v)


def anid_pago(payments: Column) -> Column:
    """Method of the first payment, or ''."""
    return F.coalesce(F.get(payments, F.lit(0))["payment_method_id"], F.lit(""))


def anid_centro(cost_center: Column) -> Column:
    return F.coalesce(cost_center["name"], F.lit("Principal"))


def anid_cantidad(quantity: Column) -> Column:
    """Null and 0 both count as one unit."""
    return F.coalesce(F.nullif(quantity, F.lit(0.0)), F.lit(1.0))


def anid_linea(quantity: Column, price: Column, taxes: Column) -> Column:
    """Line total: quantity by price plus taxes."""
    return anid_cantidad(quantity) * F.coalesce(price, F.lit(0.0)) + anid_impuesto(taxes)
