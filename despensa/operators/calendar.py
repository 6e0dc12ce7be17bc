"""Weekly calendar dimension: labels, academic week, holiday flags."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from despensa.soporte import dimension
from despensa.sources import calendar as cal

# Words of the period names that stop the academic week.
PARADAS = ("receso", "santa", "finales", "induccion")


def lunes_entre(spark: SparkSession, desde: dt.date, hasta: dt.date) -> DataFrame:
    """All Mondays of a range, one row each."""
    primero = desde - dt.timedelta(days=desde.weekday())
    n = (hasta - primero).days // 7 + 1
    return dimension(spark, ds=(pa.date32(), [primero + dt.timedelta(weeks=k) for k in range(n)]))


def jn_mapa_dia(calendario: DataFrame) -> DataFrame:
    """Label of each day; where periods overlap the later one of the calendar wins."""
    return calendario.groupBy("ds").agg(F.max_by("holiday", "ord").alias("etiqueta"))


def jn_asof_inicio(lunes: DataFrame, inicios: DataFrame) -> DataFrame:
    """Latest term start on or before each week.

    Starts join their own Monday and are carried forward, so no range join is needed. The window
    runs over one row per week.
    """
    w = Window.orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    marcados = lunes.join(F.broadcast(inicios), F.col("ds") == F.col("inicio"), "left")
    return marcados.withColumn("es_inicio", F.col("inicio").isNotNull()) \
        .withColumn("inicio", F.last("inicio", ignorenulls=True).over(w))


def _tiene(*palabras: str):
    e = F.coalesce(F.col("etiqueta"), F.lit(""))
    hay = F.lit(False)
    for p in palabras:
        hay = hay | F.contains(e, F.lit(p))
    return hay


def jn_conteo_rango(con_inicio: DataFrame, mapa: DataFrame) -> DataFrame:
    """Class weeks counted from the term start up to each week, stop weeks left out."""
    w = Window.partitionBy("inicio").orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    d = con_inicio.join(F.broadcast(mapa), "ds", "left")
    return d.withColumn("clases", F.sum(F.when(_tiene(*PARADAS), 0).otherwise(1)).over(w))


def win_semana_acad(lunes: DataFrame, calendario: DataFrame, inicios: DataFrame) -> DataFrame:
    """Academic week of each Monday of ``lunes``, which must start no later than the first term
    whose weeks are wanted."""
    d = jn_conteo_rango(jn_asof_inicio(lunes, inicios), jn_mapa_dia(calendario))
    semana = (
        F.when(F.col("es_inicio"), 1).when(_tiene("finales"), 17)
        .when(_tiene("receso", "santa", "induccion"), 0).when(_tiene("vacaciones"), -1)
        .when(F.col("inicio").isNull(), 0).otherwise(F.col("clases"))
    )
    return d.select("ds", "etiqueta", "inicio", semana.cast("int").alias("semana_academica"))


def jn_rango_festivo(calendario: DataFrame, nombres: list[str] | None = None) -> DataFrame:
    """``hol_*`` flags of the weeks that hold a day of each holiday: days are moved to their
    Monday, so the interval test becomes an equality."""
    nombres = nombres or cal.NOMBRES
    semana = calendario.select(F.date_trunc("week", "ds").cast("date").alias("ds"), "holiday")
    return semana.groupBy("ds").agg(*[
        F.max((F.col("holiday") == h).cast("int")).alias(f"hol_{h}") for h in nombres])


def calendario_semanal(spark: SparkSession, desde: dt.date, hasta: dt.date,
                       dias_atras: int = 0) -> DataFrame:
    """One row per Monday with everything the features take from the calendar."""
    calendario = cal.src_calendario(spark, dias_atras)
    inicios = cal.src_inicios(spark, dias_atras)
    primero = dt.date.fromisoformat(cal.INICIOS[0]) - dt.timedelta(days=dias_atras)
    lunes = lunes_entre(spark, min(desde, primero), hasta)
    flags = jn_rango_festivo(calendario)
    hol = [f"hol_{h}" for h in cal.NOMBRES]
    anios = (min(desde, primero).year, hasta.year + 1)
    # The baseline knows a holiday by its exact date, so only those on a Monday reach it.
    exactos = (
        calendario.select("ds", "holiday")
        .unionByName(cal.src_festivos(spark, *anios).select("ds", "holiday"))
        .groupBy("ds").agg(F.sort_array(F.collect_set("holiday")).alias("festivos"))
    )
    return (
        win_semana_acad(lunes, calendario, inicios)
        .join(F.broadcast(flags), "ds", "left").na.fill(0, hol)
        .join(F.broadcast(exactos), "ds", "left")
        .withColumn("festivos", F.coalesce("festivos", F.array().cast("array<string>")))
        .filter(F.col("ds") >= F.date_trunc("week", F.lit(desde)).cast("date"))
    )


def agg_calendario(calendario: DataFrame) -> DataFrame:
    return calendario.groupBy("holiday").agg(
        F.min("ds").alias("desde"), F.max("ds").alias("hasta"), F.count(F.lit(1)).alias("dias"))


def agg_tramos(dias: DataFrame, clave: str = "holiday", ds: str = "ds") -> DataFrame:
    """Contiguous spans of days of each key (gaps and islands)."""
    n = F.row_number().over(Window.partitionBy(clave).orderBy(ds))
    return (dias.select(clave, ds).distinct()
            .withColumn("isla", F.date_sub(F.col(ds), n))
            .groupBy(clave, "isla").agg(F.min(ds).alias("ini"), F.max(ds).alias("fin"),
                                        F.count(F.lit(1)).alias("dias")).drop("isla"))
