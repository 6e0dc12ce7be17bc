"""The forecast run over all critical products: series to the four marts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despensa.esquemas import MARTS
from despensa.functions.numbers import num_redondeo
from despensa.operators import baseline as bl
from despensa.operators import boost as bo
from despensa.operators import filters as f
from despensa.operators import panel as p
from despensa.operators import series as s
from despensa.operators.calendar import calendario_semanal
from despensa.operators.horizon import ts_confianza, ts_intervalo
from despensa.operators.segment import productos_criticos
from despensa.operators.joins import set_union
from despensa.soporte import cortar


@dataclass
class Opciones:
    """Settings of a run; the defaults are those of the batch job."""

    local: str = "Principal"
    desde: str = "2024-01-01"
    dias_atras: int = 0
    pruebas_base: int = 20
    pruebas_boost: list[dict] = field(default_factory=bo.pruebas_boost)
    reajuste: int = 1
    horizonte: int = 4
    minimo_serie: int = 40
    minimo_filas: int = 25
    sin_fuga: bool = False
    base: dict = field(default_factory=dict)  # what the baseline is made of, see ``baseline.ts_base``


def marco(serie: DataFrame, o: Opciones) -> tuple[DataFrame, DataFrame]:
    """Feature frame of history and future weeks with the tuned baseline, and the best trials.

    By default the baseline is fitted on the whole series, as in the source. ``sin_fuga`` fits it
    on the training weeks only.
    """
    ini, fin = serie.agg(F.min("ds"), F.max("ds")).first()
    fin = fin + dt.timedelta(weeks=o.horizonte + 1)
    semanas = cortar(calendario_semanal(serie.sparkSession, ini, fin, o.dias_atras))
    partes = cortar(s.win_corte(serie))
    pruebas = bl.pruebas_base(o.pruebas_base)
    mejores = cortar(bl.agg_mejor_prueba(bl.ts_ajuste_base(partes, semanas, pruebas, **o.base),
                                         *bl.COLS_PARAMS))
    extendida = cortar(s.set_expandir(serie, o.horizonte))
    entrada = extendida
    if o.sin_fuga:
        entrada = extendida.join(partes.select("producto", "ds", "parte"), ["producto", "ds"],
                                 "left").withColumn("y", F.when(F.col("parte") == "train",
                                                                F.col("y"))).drop("parte")
    base = bl.ts_base(entrada, semanas, mejores, **o.base)
    rasgos = s.ts_features(extendida, ini, fin, o.dias_atras, o.sin_fuga)
    return cortar(rasgos.join(base, ["producto", "ds"], "left")), mejores


def ts_orquestar(ventas: DataFrame, o: Opciones = Opciones()) -> dict[str, DataFrame]:
    """All products in one plan. Products that cannot be modelled end up in ``errores`` with the
    reason; nothing is raised for a single product."""
    criticos = productos_criticos(ventas, o.local, o.desde).select(
        F.col("Nombre").alias("producto"))
    serie = f.flt_cierre(s.ts_serie(ventas, criticos), dias_atras=o.dias_atras)
    serie = cortar(serie)
    cortas = f.flt_cortas(serie, o.minimo_serie, "serie muy corta")
    largas = f.flt_minimos(serie, o.minimo_serie)
    if largas.isEmpty():
        return _sin_modelos(serie, cortas)
    cuadro, _ = marco(largas, o)
    filas = cortar(bo.preparar(cuadro, o.minimo_filas))
    if filas.isEmpty():
        return _sin_modelos(serie, set_union(cortas, _pocas(cuadro, o)))

    # Each product is scored by the trial that suits it best. A trial is fitted over all products'
    # weeks, once for each origin that some product of its own has, and no other.
    elegidas = cortar(bl.agg_mejor_prueba(bo.ts_ajuste_boost(filas, o.pruebas_boost)))
    suyas = cortar(filas.join(elegidas.select("producto", "prueba"), "producto"))
    nodos = bo.ajustes_wf(filas, o.pruebas_boost, o.reajuste, cuales=bo.ajustes_usados(suyas, o.reajuste, o.horizonte))
    test = cortar(bo.ts_holdout(suyas, nodos=nodos))
    anchos = bo.cuantiles_h(bo.ts_wf_multi(suyas, None, o.horizonte, o.reajuste, nodos=nodos))
    escala = suyas.groupBy("producto").agg(F.first("escala").alias("escala"), F.first("prueba").alias("prueba"))
    historia = cuadro.filter("y IS NOT NULL").select("producto", "ds", "y").join(escala, "producto")
    h = bo.ts_horizonte(historia, cuadro.filter("y IS NULL"), nodos, o.horizonte)
    medidas = bo.met_holdout(test).filter(F.col("n_test") > 0)
    h = (h.join(anchos, ["producto", "semana_offset"], "left")
         .join(medidas.select("producto", "std_residual"), "producto"))
    cuatro = cortar(ts_intervalo(h).select(
        "producto", "semana_offset", "fecha", num_redondeo("prediccion", 1).alias("prediccion"),
        num_redondeo("prediccion_lower", 1).alias("prediccion_lower"),
        num_redondeo("prediccion_upper", 1).alias("prediccion_upper"),
        num_redondeo("prophet_solo", 1).alias("prophet_solo"),
        ts_confianza("semana_offset").alias("confianza_pct")))
    resumen = ts_resumen(serie, cuatro, medidas)
    precios = p.agg_precio(ventas).join(resumen.select("producto"), "producto", "left_semi") \
        .withColumn("precio_unitario", num_redondeo("precio_unitario", 0))
    return {
        "predicciones_top10": resumen,
        "predicciones_4_semanas": cuatro,
        "historial_walkforward": test.filter("real > 0").select(
            "ds", "real", "prediccion", "prophet", "producto"),
        "precios_unitarios": precios,
        "errores": set_union(cortas, _pocas(cuadro, o), _inactivas(filas, medidas)),
        "pruebas": elegidas,
    }


def _sin_modelos(serie: DataFrame, errores: DataFrame) -> dict[str, DataFrame]:
    """Empty marts beside the reasons, when no product can be modelled."""
    vacios = {n: serie.sparkSession.createDataFrame([], e) for n, e in MARTS.items()}
    return {**vacios, "errores": errores}


def _pocas(cuadro: DataFrame, o: Opciones) -> DataFrame:
    return (cuadro.filter("y IS NOT NULL").groupBy("producto")
            .agg(F.count_if(_completa()).alias("n_semanas"))
            .filter(F.col("n_semanas") < o.minimo_filas)
            .withColumn("error", F.lit("pocas filas modelables")))


def _inactivas(filas: DataFrame, medidas: DataFrame) -> DataFrame:
    return (filas.groupBy("producto").agg(F.count(F.lit(1)).alias("n_semanas"))
            .join(medidas, "producto", "left_anti")
            .withColumn("error", F.lit("sin semanas activas en prueba")))


def _completa():
    c = F.lit(True)
    for x in s.FEATURES:
        c = c & F.col(x).isNotNull()
    return c


def ts_resumen(serie: DataFrame, cuatro: DataFrame, medidas: DataFrame) -> DataFrame:
    """One row per product: next week's forecast beside the back-test figures, best first."""
    semanas = serie.groupBy("producto").agg(F.count(F.lit(1)).alias("n_semanas"))
    proxima = cuatro.filter("semana_offset = 1").select(
        "producto", F.col("fecha").alias("fecha_proxima_semana"), "prediccion", "prophet_solo")
    return (
        proxima.join(semanas, "producto").join(medidas, "producto")
        .select("producto", "n_semanas", "fecha_proxima_semana", "prediccion", "prophet_solo",
                num_redondeo("mae_hibrido", 2).alias("mae_hibrido"),
                num_redondeo("smape_hibrido", 3).alias("smape_hibrido"),
                num_redondeo("mae_prophet", 2).alias("mae_prophet"),
                num_redondeo("mejora_mae", 2).alias("mejora_mae"),
                num_redondeo("std_residual", 2).alias("std_residual"))
        .orderBy("mae_hibrido", "producto")
    )
