"""Row filters. All are plain predicates, so they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value. Closed for rebuilding: these weeks hold no demand.
CIERRE = ("2024-10-01", "2024-12-31")


def flt_tipo(df: DataFrame, tipo: str, col: str = "Tipo_transaccion") -> DataFrame:
    return df.filter(F.col(col) == tipo)


def flt_local_fecha(df: DataFrame, local: str = "Principal", desde: str = "2024-01-01") -> DataFrame:
    return df.filter((F.col("Establecimiento") == local) &
                     (F.col("Fecha") >= F.lit(desde).cast("date")))


def flt_rango(df: DataFrame, mes_ini: str, mes_fin: str, local: str | None = None,
              fecha: str = "Fecha") -> DataFrame:
    """Months between two yyyy-MM, as a date range so the scan can use it; a ledger laid out by
    month is pruned to its folders too."""
    desde = F.to_date(F.lit(mes_ini + "-01"))
    hasta = F.add_months(F.to_date(F.lit(mes_fin + "-01")), 1)
    df = df.filter((F.col(fecha) >= desde) & (F.col(fecha) < hasta))
    if "mes" in df.columns:
        df = df.filter(F.col("mes").between(mes_ini, mes_fin))
    return df if local in (None, "Todos") else df.filter(F.col("Establecimiento") == local)


def flt_costos(df: DataFrame) -> DataFrame:
    """Real costs only: payments settle invoices that are already counted."""
    return df.filter(F.col("Tipo").isin("Compra/Gasto", "Documento soporte"))


def flt_nulos(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def flt_cierre(df: DataFrame, ini: str = CIERRE[0], fin: str = CIERRE[1], ds: str = "ds",
               dias_atras: int = 0) -> DataFrame:
    """Drops weeks that start inside the closure."""
    a = F.date_sub(F.to_date(F.lit(ini)), dias_atras)
    b = F.date_sub(F.to_date(F.lit(fin)), dias_atras)
    return df.filter(~F.col(ds).between(a, b))


def flt_activas(df: DataFrame, y: str = "y") -> DataFrame:
    return df.filter(F.col(y) > 0)


def flt_completas(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def flt_minimos(df: DataFrame, minimo: int, clave: str = "producto") -> DataFrame:
    """Series with at least ``minimo`` rows. A series has one row per week, so groups are small."""
    n = F.count(F.lit(1)).over(Window.partitionBy(clave))
    return df.withColumn("_n", n).filter(F.col("_n") >= minimo).drop("_n")


def flt_cortas(df: DataFrame, minimo: int, error: str, clave: str = "producto") -> DataFrame:
    """The series ``flt_minimos`` leaves out, with the reason."""
    return (df.groupBy(clave).agg(F.count(F.lit(1)).alias("n_semanas"))
            .filter(F.col("n_semanas") < minimo).withColumn("error", F.lit(error)))


def flt_recientes(df: DataFrame, dias: int = 90, fecha: str = "Fecha") -> DataFrame:
    """Last ``dias`` days before the newest date. The newest date is one scalar from a partial
    aggregate over one column, not a window over the ledger."""
    ultimo = df.select(F.max(fecha)).scalar()
    return df.filter(F.col(fecha) >= F.date_sub(ultimo, dias))


def flt_pasadas(df: DataFrame, asof: Column, fecha: str = "fecha") -> DataFrame:
    """Forecast weeks already over at ``asof``."""
    return df.filter(F.col(fecha) < asof)


def flt_hist_fut(df: DataFrame, ultimo: Column, ds: str = "ds") -> DataFrame:
    """Marks forecast rows as history or future of the last observed date."""
    return df.withColumn("tramo", F.when(F.col(ds) <= ultimo, "historia").otherwise("futuro"))


def flt_ventana(df: DataFrame, hasta: Column, desde: Column | None = None, dias: int = 7,
                fecha: str = "Fecha") -> DataFrame:
    """Invoices created in [desde, hasta]; by default the last ``dias`` days."""
    ini = F.date_sub(hasta, dias) if desde is None else desde
    return df.filter(F.col(fecha).between(ini, hasta))


def flt_solape(periodos: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Periods (nombre, ini, fin) that meet [lo, hi], clipped to it."""
    return (periodos.filter((F.col("ini") <= hi) & (F.col("fin") >= lo))
            .withColumn("ini", F.greatest("ini", lo)).withColumn("fin", F.least("fin", hi)))


def flt_encabezado(df: DataFrame, col: str = "receta") -> DataFrame:
    """Recipe sheet rows other than headers."""
    return df.filter(F.coalesce(F.lower(F.trim(F.col(col))) != "receta", F.lit(True)))
