"""Gap-free weekly series and the features made from them, all products at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from despensa.functions import dates as fd
from despensa.functions.dates import fec_lunes
from despensa.operators.calendar import calendario_semanal
from despensa.sources import calendar as cal
from despensa.soporte import cortar

# ---- fixed values: column names of the published feature tables, written in ASCII ----
# The inputs of the residual model, in order.
FEATURES = [
    "yhat", "yhat_lower", "yhat_upper", "mes", "semana_anio", "trimestre",
    "lag_1", "lag_2", "lag_4", "rolling_4", "rolling_8",
    "hol_semana_santa", "hol_semana_receso_verano", "hol_examenes_finales",
    "hol_vacaciones_verano", "hol_semana_receso_invierno", "hol_vacaciones_invierno",
    "hol_cierre_oct_dic_2024", "semanas_antes_verano",
]
# Those of the exploratory variant.
FEATURES_HIBRIDO = [
    "yhat", "yhat_lower", "yhat_upper", "semana_academica", "pre_evento", "inicio_parciales_1",
    "fin_parciales_1", "inicio_parciales_2", "fin_parciales_2", "mes_sin", "mes_cos",
    "semana_sin", "semana_cos", "lag_1_clean", "rolling_4", "vuelta_a_clases", "post_vacaciones",
]
# --------------------------------------------------------------------------------------


def ts_serie(ventas: DataFrame, solo: DataFrame | None = None) -> DataFrame:
    """Weekly units of every product over the weeks of the whole ledger, 0 where none were sold.

    ``solo`` (producto) keeps these products before their gaps are filled.

    Weekly sums are stored, so the ledger is read once; its date range, two numbers, comes from
    them. Each sold week then fills the weeks up to the next one by itself: no product-by-week
    cross join, and the result is already partitioned by product for the windows that follow.
    """
    semanal = cortar(
        ventas.groupBy(F.col("Nombre").alias("producto"), fec_lunes("Fecha").alias("ds"))
        .agg(F.sum("Cantidad").alias("y")).filter("ds IS NOT NULL"))
    ini, fin = semanal.agg(F.min("ds"), F.max("ds")).first()
    semanal = semanal.filter("producto IS NOT NULL")
    if solo is not None:
        semanal = semanal.join(solo, "producto", "left_semi")
    return jn_calendario(semanal, ini, fin)


def jn_calendario(semanal: DataFrame, ini: dt.date, fin: dt.date) -> DataFrame:
    """Calendar weeks drive; a missing week counts 0."""
    w = Window.partitionBy("producto").orderBy("ds")
    siete = F.expr("interval 7 days")
    desde = F.when(F.row_number().over(w) == 1, F.lit(ini)).otherwise(F.col("ds"))
    hasta = F.coalesce(F.date_sub(F.lead("ds").over(w), 7), F.lit(fin))
    return (
        semanal.withColumns({"_a": desde, "_b": hasta})
        .select("producto", F.explode(F.sequence("_a", "_b", siete)).alias("semana"), "ds", "y")
        .select("producto", F.col("semana").alias("ds"),
                F.when(F.col("semana") == F.col("ds"), F.coalesce("y", F.lit(0.0)))
                .otherwise(0.0).alias("y"))
    )


def set_expandir(serie: DataFrame, semanas: int) -> DataFrame:
    """Adds ``semanas`` future weeks with null y after each product's last week."""
    ultima = serie.groupBy("producto").agg(F.max("ds").alias("u"))
    futuras = ultima.select("producto", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(semanas)), lambda i: F.date_add("u", i * 7))).alias("ds"))
    return serie.unionByName(futuras.withColumn("y", F.lit(None).cast("double")))


ts_futuro = set_expandir


def _w():
    return Window.partitionBy("producto").orderBy("ds")


def win_lags(df: DataFrame, rezagos: tuple[int, ...] = (1, 2, 4)) -> DataFrame:
    """Row lags, not calendar lags: after closed weeks are dropped the last open week comes first."""
    return df.withColumns({f"lag_{k}": F.lag("y", k).over(_w()) for k in rezagos})


def win_rolling(df: DataFrame, anchos: tuple[int, ...] = (4, 8)) -> DataFrame:
    """Mean of the previous k rows, null until there are k values."""
    def media(k: int):
        v = _w().rowsBetween(-k, -1)
        return F.when(F.count("y").over(v) == k, F.avg("y").over(v))

    return df.withColumns({f"rolling_{k}": media(k) for k in anchos})


def win_pre_evento(df: DataFrame) -> DataFrame:
    sig = F.lead("semana_academica").over(_w())
    return df.withColumn("pre_evento", F.coalesce((sig == 0).cast("int"), F.lit(0)))


def win_post_vac(df: DataFrame) -> DataFrame:
    previa = F.coalesce(F.lag("semana_academica").over(_w()) == -1, F.lit(False))
    return df.withColumn("post_vacaciones",
                         ((F.col("semana_academica") == 1) | previa).cast("int"))


def agg_media_cond(df: DataFrame, sin_fuga: bool = False) -> DataFrame:
    """Mean y of the product's weeks with the same academic week; ``sin_fuga`` uses only the
    weeks before."""
    w = Window.partitionBy("producto", "semana_academica")
    if sin_fuga:
        w = w.orderBy("ds").rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("media_semana", F.avg("y").over(w))


def win_lag_limpio(df: DataFrame, sin_fuga: bool = False) -> DataFrame:
    """lag_1, but the mean of like weeks when last week was 0 at the start of classes."""
    cero = (F.col("lag_1") == 0) & F.col("semana_academica").isin(1, 2)
    return agg_media_cond(df, sin_fuga).withColumn(
        "lag_1_clean",
        F.when(cero, F.coalesce("media_semana", "lag_1")).otherwise(F.col("lag_1")),
    ).drop("media_semana")


def ts_features(serie: DataFrame, ini: dt.date, fin: dt.date, dias_atras: int = 0,
                sin_fuga: bool = False) -> DataFrame:
    """All features of every product-week.

    ``ini`` and ``fin`` bound the weeks of ``serie``. The calendar side has one row per week of
    that range, so its broadcast is bounded by the calendar; the windows all use one partitioning.
    """
    spark = serie.sparkSession
    semanas = calendario_semanal(spark, ini, fin, dias_atras).drop("etiqueta", "inicio")
    verano = min(b[1] for b in cal.BLOQUES if b[0] == "vacaciones_verano")
    verano = F.lit(dt.date.fromisoformat(verano) - dt.timedelta(days=dias_atras))
    semanas = semanas.withColumns({
        **fd.fec_calendario("ds"), **fd.fec_ciclicas("ds"), **fd.fec_marcas("semana_academica"),
        "semanas_antes_verano": fd.fec_antes_verano("ds", verano),
    })
    df = serie.join(F.broadcast(semanas), "ds", "left")
    df = win_post_vac(win_pre_evento(win_rolling(win_lags(df, (1, 2, 4, 52)))))
    df = win_lag_limpio(df, sin_fuga)
    return df.withColumn("lag_x_parciales", fd.fec_interaccion("lag_1", "inicio_parciales_1"))


# ---- ordered splits ----


def con_posicion(df: DataFrame) -> DataFrame:
    """Row number and row count of each series."""
    return df.withColumns({
        "i": F.row_number().over(_w()),
        "n": F.count(F.lit(1)).over(Window.partitionBy("producto")),
    })


def win_corte(df: DataFrame, partes: tuple[float, ...] = (0.80,),
              nombres: tuple[str, ...] = ("train", "test"), minimos: bool = True) -> DataFrame:
    """Splits each series in order, e.g. 80/20 or 65/15/20.

    When three parts would leave the middle one empty, the last four rows are shared out two and
    two instead.
    """
    d = con_posicion(df)
    cortes = [F.floor(F.lit(p) * F.col("n")) for p in partes]
    if len(cortes) == 2 and minimos:
        vacia = cortes[1] <= cortes[0]
        cortes = [F.when(vacia, F.greatest(F.lit(1), F.col("n") - 4)).otherwise(cortes[0]),
                  F.when(vacia, F.greatest(F.lit(2), F.col("n") - 2)).otherwise(cortes[1])]
    parte = None
    for c, nombre in zip(cortes, nombres):
        cond = F.col("i") <= c
        parte = F.when(cond, nombre) if parte is None else parte.when(cond, nombre)
    return d.withColumn("parte", parte.otherwise(nombres[-1]))


def win_folds(df: DataFrame, k: int = 3) -> DataFrame:
    """Expanding time folds: the last k blocks of n div (k+1) rows are validated in turn.

    Each row gets the fold it is validated in (null for the first block); it trains every later
    fold.
    """
    d = con_posicion(df)
    bloque = F.floor(F.col("n") / (k + 1))
    inicio = F.col("n") - F.lit(k) * bloque
    pliegue = F.floor((F.col("i") - 1 - inicio) / F.when(bloque > 0, bloque)) + 1
    return d.withColumn("pliegue", F.when(F.col("i") > inicio, pliegue).cast("int"))


def ts_cero(df: DataFrame, cuando, cols: tuple[str, ...] = ("yhat", "yhat_lower", "yhat_upper")
            ) -> DataFrame:
    """Forecast 0 where the condition says the place was closed."""
    return df.withColumns({c: F.when(cuando, 0.0).otherwise(F.col(c)) for c in cols})


def ts_residuo(df: DataFrame, y: str = "y", base: str = "yhat") -> DataFrame:
    return df.withColumn("residuo", F.col(y) - F.col(base))


def flt_modelables(df: DataFrame, features: list[str], minimo: int) -> DataFrame:
    """Observed rows with every model input, of series that keep at least ``minimo`` of them."""
    from despensa.operators.filters import flt_completas, flt_minimos
    return flt_minimos(flt_completas(df, [*features, "y"]), minimo)
