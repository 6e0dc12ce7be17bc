"""Model queries, on every product of the given tables.

A fit has no SQL form, but special cases have: without bends, season, holidays and penalty the baseline
is a least-squares line; one tree of depth one on one yes-or-no input is a mean per group. The
queries of the operator ids run these cases through the same code as any other. Those named
``_modelo`` run the full models and are compared by rows only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from despensa.operators import baseline as bl
from despensa.operators import boost as bo
from despensa.operators import series as s
from despensa.operators.calendar import calendario_semanal
from despensa.operators.joins import set_union
from despensa.plans import segmentacion  # noqa: F401  declares v_criticos
from despensa.plans import series as ps
from despensa.plans.bindings import DESPLAZAMIENTO, vista
from despensa.plans.forecast import Opciones, marco, ts_orquestar, ts_resumen
from despensa.plans.registro import consulta
from despensa.soporte import cortar

# The budget the registered queries search and re-fit with; the library's defaults are the full
# ranges (100 to 600 trees, 30 trials, a re-fit for every week).
PRUEBAS = bo.pruebas_boost(2, arboles=(10, 16), profundidad=(2, 4))
OPCIONES = Opciones(desde="1996-01-01", dias_atras=DESPLAZAMIENTO, pruebas_boost=PRUEBAS,
                    reajuste=13)


def _serie(t):
    return cortar(ps.abierta(t))


def _semanas(t, serie, extra: int = 5):
    ini, fin = serie.agg(F.min("ds"), F.max("ds")).first()
    return calendario_semanal(t.spark, ini, fin + dt.timedelta(weeks=extra), DESPLAZAMIENTO)


def _filas(t):
    """Model rows of all products."""
    cuadro, _ = marco(_serie(t), OPCIONES)
    return cortar(bo.preparar(cuadro))


@consulta("jn_busqueda", """
SELECT producto, CAST(k AS INTEGER) AS prueba, semanas
FROM (SELECT producto, COUNT(*) AS semanas FROM v_abierta GROUP BY 1) s, range(0, 20) r(k)""")
def _(t):
    claves = ps.abierta(t).groupBy("producto").agg(F.count(F.lit(1)).alias("semanas"))
    return bl.jn_busqueda(claves, bl.pruebas_base(20)).select("producto", "prueba", "semanas")


@consulta("ts_base_modelo")
def _(t):
    serie = _serie(t)
    return bl.ts_base(s.set_expandir(serie, 4), _semanas(t, serie))


@consulta("ts_base_anual_modelo")
def _(t):
    serie = _serie(t)
    return bl.ts_base_anual(serie, _semanas(t, serie, 27))


@consulta("ts_ajuste_base_modelo")
def _(t):
    serie = _serie(t)
    return bl.ts_ajuste_base(s.win_corte(serie), _semanas(t, serie), bl.pruebas_base(20))


@consulta("agg_mejor_prueba", """
SELECT producto, arg_min(k, (mae, k)) AS prueba, MIN(mae) AS mae FROM (
  SELECT producto, CAST(0 AS INTEGER) AS k, AVG(ABS("real" - prediccion)) AS mae FROM v_historial
  GROUP BY 1 UNION ALL
  SELECT producto, 1, AVG(ABS("real" - prophet)) FROM v_historial GROUP BY 1 UNION ALL
  SELECT producto, 2, AVG(ABS("real" - (prophet + prediccion) / 2)) FROM v_historial GROUP BY 1) x
GROUP BY producto""", dobles="mae:6")
def _(t):
    h = cortar(t.historial())
    cand = [F.col("prediccion"), F.col("prophet"), (F.col("prophet") + F.col("prediccion")) / 2]
    pruebas = set_union(*[
        h.groupBy("producto").agg(F.avg(F.abs(F.col("real") - c)).alias("mae"))
        .withColumn("prueba", F.lit(i)) for i, c in enumerate(cand)])
    return bl.agg_mejor_prueba(pruebas)


@consulta("ts_boost_modelo")
def _(t):
    filas = _filas(t)
    return bo.predecir(filas, bo.ts_boost(filas, PRUEBAS[0])).select(
        "producto", "ds", "y", "yhat", "prediccion")


# One tree of depth one on one yes-or-no input is a mean per group, which SQL can follow.
RAIZ = {"prueba": 0, "arboles": 1, "paso": 1.0, "profundidad": 1, "muestra": 1.0, "columnas": 1.0, "minimo_hoja": 1}
UNA = ["mes"]


def _dos_grupos(t):
    """Model rows of the stand-in forecasts: the input says whether the month is even."""
    return cortar(s.con_posicion(t.historial()).select(
        "producto", "ds", F.col("real").alias("y"), F.col("prophet").alias("yhat"),
        F.lit(1.0).alias("escala"), (F.month("ds") % 2).cast("double").alias("mes"), "i", "n",
        F.floor(F.col("n") * 0.8).cast("int").alias("corte")))


vista("v_dos_grupos", """
SELECT *, CAST(floor(n * 0.8) AS INTEGER) AS corte FROM (
  SELECT producto, ds, "real" AS y, prophet AS yhat, month(ds) % 2 AS par,
         ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i,
         COUNT(*) OVER (PARTITION BY producto) AS n FROM v_historial) x""", "v_historial")


GRUPOS = """
SELECT producto, ds, GREATEST(0, yhat + AVG(y - yhat) OVER (PARTITION BY par)) AS prediccion
FROM v_dos_grupos"""
GRUPOS_PRUEBA = """
SELECT producto, ds, y AS "real", GREATEST(0, yhat + r) AS prediccion, yhat AS prophet
FROM v_dos_grupos JOIN (SELECT par, AVG(y - yhat) AS r FROM v_dos_grupos WHERE i <= corte GROUP BY 1) m
USING (par) WHERE i > corte"""


@consulta("ts_boost_grupos", GRUPOS, dobles="prediccion:4")
@consulta("ts_boost", GRUPOS, dobles="prediccion:4")
def _(t):
    filas = _dos_grupos(t)
    return bo.predecir(filas, bo.ts_boost(filas, RAIZ, UNA), UNA).select("producto", "ds", "prediccion")


@consulta("ts_holdout_grupos", GRUPOS_PRUEBA, dobles="prediccion:4 prophet:4")
@consulta("ts_holdout", GRUPOS_PRUEBA, dobles="prediccion:4 prophet:4")
def _(t):
    return bo.ts_holdout(_dos_grupos(t), RAIZ, UNA)


# Mean residual of each group over the weeks known when a stretch of one test week starts.
vista("v_sabido", """
SELECT par, k, SUM(s) OVER (PARTITION BY par ORDER BY k) / SUM(c) OVER (PARTITION BY par ORDER BY k) AS r
FROM (SELECT par, i - corte AS k, SUM(y - yhat) AS s, COUNT(*) AS c FROM v_dos_grupos GROUP BY 1, 2) x""", "v_dos_grupos")


@consulta("ts_wf_paso1", """
SELECT producto, ds, y AS "real", CASE WHEN yhat = 0 THEN 0 ELSE GREATEST(0, yhat + r) END AS prediccion,
  yhat AS prophet
FROM (SELECT *, i - corte - 1 AS antes FROM v_dos_grupos WHERE i > corte) d
ASOF JOIN v_sabido s ON d.par = s.par AND d.antes >= s.k""", dobles="prediccion:4 prophet:4")
def _(t):
    return bo.ts_wf_paso1(_dos_grupos(t), RAIZ, 1, UNA)


@consulta("ts_wf_multi", """
SELECT producto, origen, h, ds, y AS "real", GREATEST(0, yhat + r) AS prediccion FROM (
  SELECT o.producto, o.ds AS origen, CAST(d.i - o.i + 1 AS INTEGER) AS h, d.ds, d.y, d.yhat, d.par,
    o.i - o.corte - 1 AS antes
  FROM v_dos_grupos o JOIN v_dos_grupos d ON d.producto = o.producto AND d.i BETWEEN o.i AND o.i + 3
  WHERE o.i > o.corte AND o.i <= o.n - 3) d
ASOF JOIN v_sabido s ON d.par = s.par AND d.antes >= s.k""", dobles="prediccion:4")
def _(t):
    return bo.ts_wf_multi(_dos_grupos(t), RAIZ, 4, 1, UNA)


@consulta("ts_horizonte", """
SELECT producto, CAST(i - n + 4 AS INTEGER) AS semana_offset, ds + 28 AS fecha, GREATEST(0, yhat + r) AS prediccion,
  yhat AS prophet_solo
FROM v_dos_grupos d JOIN (SELECT par, AVG(y - yhat) AS r FROM v_dos_grupos GROUP BY 1) m
  ON m.par = month(d.ds + 28) % 2
WHERE i > n - 4 AND n >= 4""", dobles="prediccion:4 prophet_solo:4")
def _(t):
    filas = _dos_grupos(t)
    futuras = filas.filter(F.col("i") > F.col("n") - 4).withColumn("ds", F.date_add("ds", 28)).withColumn(
        "mes", (F.month("ds") % 2).cast("double"))
    nodos = bo.ajustes_wf(filas, [RAIZ], 1, UNA, {(0, -1)})
    return bo.ts_horizonte(filas.select("producto", "ds", "y", "escala"), futuras, nodos, 4, UNA, RAIZ)


# A second tree finds nothing left, so both counts of trees score the same from one fit.
@consulta("ts_ajuste_boost", """
SELECT * FROM (
WITH f AS (
  SELECT *, CASE WHEN i > corte - 3 * (corte // 4) THEN (i - 1 - (corte - 3 * (corte // 4))) // (corte // 4) + 1 END AS pliegue
  FROM v_dos_grupos WHERE i <= corte),
m AS (
  SELECT v.fold, par, AVG(y - yhat) AS r FROM f JOIN (VALUES (1), (2), (3)) v(fold)
    ON coalesce(pliegue, 0) < v.fold GROUP BY 1, 2),
e AS (
  SELECT producto, pliegue, AVG(ABS(y - GREATEST(0, yhat + r))) AS mae FROM f JOIN m ON m.fold = pliegue AND m.par = f.par
  GROUP BY 1, 2)
SELECT producto, CAST(prueba AS INTEGER) AS prueba, AVG(mae) AS mae FROM e, (VALUES (0), (1)) p(prueba) GROUP BY 1, 2) z""",
          dobles="mae:4")
def _(t):
    return bo.ts_ajuste_boost(_dos_grupos(t), [RAIZ, {**RAIZ, "prueba": 1, "arboles": 2}], 3, UNA)


@consulta("met_importancia", """
SELECT 'mes' AS feature, g AS importancia, 1 AS usos, g AS total, 1.0::DOUBLE AS parte FROM (
  SELECT SUM(n * r * r) - SUM(n * r) * SUM(n * r) / SUM(n) AS g FROM (
    SELECT par, COUNT(*) AS n, AVG(y - yhat) AS r FROM v_dos_grupos GROUP BY 1) x) y""",
          dobles="importancia:2 total:2")
def _(t):
    return bo.met_importancia(bo.ajustes_wf(_dos_grupos(t), [RAIZ], 1, UNA, {(0, -1)}), UNA)


# The baseline without bends, season, holidays and penalty.
RECTA = {"orden": 0, "quiebres": 0, "pena": 0.0, "festivos": False}
vista("v_recta", """
SELECT producto, a, b, sqrt(AVG((y - a - b * x) * (y - a - b * x))) AS s, MAX(ds) AS ultima FROM (
  SELECT *, date_diff('day', DATE '1990-01-01', ds) AS x FROM v_abierta) d
JOIN (SELECT producto, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM (
  SELECT *, date_diff('day', DATE '1990-01-01', ds) AS x FROM v_abierta) d GROUP BY 1) r USING (producto)
GROUP BY producto, a, b""", "v_abierta")
FILAS_RECTA = """
SELECT producto, ds, y, a + b * date_diff('day', DATE '1990-01-01', ds) AS f, s FROM (
  SELECT producto, ds, y FROM v_abierta
  UNION ALL SELECT producto, ultima + CAST(7 * k AS INTEGER), NULL FROM v_recta, range(1, {semanas} + 1) q(k)) d
JOIN v_recta USING (producto)"""


@consulta("ts_base", f"""
SELECT producto, ds, GREATEST(0, f) AS yhat, GREATEST(0, f - {bl.Z80} * s) AS yhat_lower,
  GREATEST(0, f + {bl.Z80} * s) AS yhat_upper FROM ({FILAS_RECTA.format(semanas=4)}) x""",
          dobles="yhat yhat_lower yhat_upper")
def _(t):
    serie = _serie(t)
    return bl.ts_base(s.set_expandir(serie, 4), _semanas(t, serie, 5), entero=False, **RECTA)


@consulta("ts_base_anual", f"""
SELECT producto, ds, CASE WHEN y = 0 THEN 0 ELSE GREATEST(0, f) END AS yhat
FROM ({FILAS_RECTA.format(semanas=26)}) x""", dobles="yhat")
def _(t):
    serie = _serie(t)
    return bl.ts_base_anual(serie, _semanas(t, serie, 27), **RECTA).select("producto", "ds", "yhat")


@consulta("ts_ajuste_base", f"""
SELECT * FROM (
WITH d AS (
  SELECT *, date_diff('day', DATE '1990-01-01', ds) AS x, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i,
    COUNT(*) OVER (PARTITION BY producto) AS n FROM v_abierta),
r AS (
  SELECT producto, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, COUNT(*) AS c FROM d WHERE i <= floor(0.8 * n) GROUP BY 1),
m AS (
  SELECT producto, AVG(ABS(CEIL(GREATEST(0, round(a + b * x, 6))) - y)) FILTER (WHERE i > floor(0.8 * n) AND y > 0) AS mae
  FROM d JOIN r USING (producto) GROUP BY 1)
SELECT producto, CAST(k AS INTEGER) AS prueba, CASE WHEN c > 2 THEN coalesce(mae, {bl.FALLO}) ELSE {bl.FALLO} END AS mae
FROM (SELECT DISTINCT producto FROM d) p LEFT JOIN r USING (producto) LEFT JOIN m USING (producto), range(0, 3) q(k)) z""",
          dobles="mae")
def _(t):
    serie = _serie(t)
    return bl.ts_ajuste_base(s.win_corte(serie), _semanas(t, serie, 5), bl.pruebas_base(3), **RECTA).select(
        "producto", "prueba", "mae")


@consulta("met_importancia_modelo")
def _(t):
    return bo.met_importancia(bo.ajustes_wf(_filas(t), PRUEBAS[:1], cuales={(0, -1)}))


@consulta("ts_ajuste_boost_modelo")
def _(t):
    return bo.ts_ajuste_boost(_filas(t), PRUEBAS)


@consulta("ts_holdout_modelo")
def _(t):
    return bo.met_holdout(bo.ts_holdout(_filas(t), PRUEBAS[0]))


@consulta("ts_wf_paso1_modelo")
def _(t):
    return bo.ts_wf_paso1(_filas(t), PRUEBAS[0], OPCIONES.reajuste)


@consulta("ts_wf_multi_modelo")
def _(t):
    return bo.cuantiles_h(bo.ts_wf_multi(_filas(t), PRUEBAS[0], 4, OPCIONES.reajuste))


@consulta("ts_horizonte_modelo")
def _(t):
    cuadro, _ = marco(_serie(t), OPCIONES)
    filas = cortar(bo.preparar(cuadro))
    escala = filas.groupBy("producto").agg(F.first("escala").alias("escala"))
    historia = cuadro.filter("y IS NOT NULL").select("producto", "ds", "y").join(escala, "producto")
    nodos = bo.ajustes_wf(filas, PRUEBAS[:1], cuales={(0, -1)})
    return bo.ts_horizonte(historia, cuadro.filter("y IS NULL"), nodos, prueba=PRUEBAS[0])


# A whole run with the line as baseline and a single leaf, the mean residual, as booster: a re-fit for every
# week of every product, bands from the multi-step back-test, the horizon.
HOJA = {"prueba": 0, "arboles": 1, "paso": 1.0, "profundidad": 0, "muestra": 1.0, "columnas": 1.0, "minimo_hoja": 1}
vista("v_corrida", """
SELECT *, CAST(floor(n * 0.8) AS INTEGER) AS corte, (y - yhat) / escala AS r FROM (
  SELECT *, GREATEST(1, AVG(y) FILTER (WHERE i <= floor(n * 0.8)) OVER (PARTITION BY producto)) AS escala FROM (
    SELECT producto, ds, y, CEIL(GREATEST(0, a + b * date_diff('day', DATE '1990-01-01', ds))) AS yhat,
      ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i, COUNT(*) OVER (PARTITION BY producto) AS n
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS semana FROM v_abierta) s
    JOIN v_recta USING (producto)
    WHERE semana > 8 AND producto IN (SELECT Nombre FROM v_criticos)) x) x""", "v_abierta", "v_recta", "v_criticos")
vista("v_corrida_sabido", """
SELECT k, SUM(s) OVER (ORDER BY k) / SUM(c) OVER (ORDER BY k) AS m FROM (
  SELECT GREATEST(i - corte, 0) AS k, SUM(r) AS s, COUNT(*) AS c FROM v_corrida GROUP BY 1) x""", "v_corrida")


@consulta("ts_orquestar", """
SELECT * FROM (
WITH prueba AS (
  SELECT producto, STDDEV_POP(y - p) FILTER (WHERE y > 0) AS std, COUNT(*) FILTER (WHERE y > 0) AS activas FROM (
    SELECT *, GREATEST(0, yhat + (SELECT m FROM v_corrida_sabido WHERE k = 0) * escala) AS p FROM v_corrida WHERE i > corte) x
  GROUP BY 1),
ancho AS (
  SELECT producto, h, CASE WHEN COUNT(e) >= 3 THEN QUANTILE_CONT(e, 0.8) END AS p80 FROM (
    SELECT o.producto, d.i - o.i + 1 AS h,
      CASE WHEN d.y > 0 THEN ABS(d.y - GREATEST(0, d.yhat + m * d.escala)) END AS e
    FROM v_corrida o JOIN v_corrida d ON d.producto = o.producto AND d.i BETWEEN o.i AND o.i + 3
    JOIN v_corrida_sabido ON k = o.i - o.corte - 1
    WHERE o.i > o.corte AND o.i <= o.n - 3) x GROUP BY 1, 2),
futuro AS (
  SELECT producto, CAST(h AS INTEGER) AS h, ultima + CAST(7 * h AS INTEGER) AS fecha, yhat,
    GREATEST(0, yhat + (SELECT AVG(r) FROM v_corrida) * escala) AS p
  FROM (SELECT *, CEIL(GREATEST(0, a + b * date_diff('day', DATE '1990-01-01', ultima + CAST(7 * h AS INTEGER)))) AS yhat
        FROM v_recta, range(1, 5) q(h)) x
  JOIN (SELECT DISTINCT producto, escala FROM v_corrida) e USING (producto))
SELECT producto, h AS semana_offset, fecha, CAST(format('{:.1f}', p) AS DOUBLE) AS prediccion,
  CAST(format('{:.1f}', GREATEST(0, p - w)) AS DOUBLE) AS prediccion_lower, CAST(format('{:.1f}', p + w) AS DOUBLE) AS prediccion_upper,
  CAST(format('{:.1f}', yhat) AS DOUBLE) AS prophet_solo, CAST(GREATEST(50, 80 - 7 * (h - 1)) AS INTEGER) AS confianza_pct
FROM (SELECT f.*, coalesce(NULLIF(p80, 0), CASE WHEN activas > 1 THEN std ELSE 0 END * (1 + 0.15 * (f.h - 1))) AS w
      FROM futuro f JOIN prueba USING (producto) LEFT JOIN ancho a ON a.producto = f.producto AND a.h = f.h
      WHERE activas > 0) z) z""")
def _(t):
    opciones = Opciones(desde="1996-01-01", dias_atras=DESPLAZAMIENTO, pruebas_base=2, pruebas_boost=[HOJA], base=RECTA)
    return ts_orquestar(t.ventas(), opciones)["predicciones_4_semanas"]


@consulta("ts_orquestar_modelo")
def _(t):
    return ts_orquestar(t.ventas(), OPCIONES)["predicciones_4_semanas"]


@consulta("ts_orquestar_resumen")
def _(t):
    return ts_orquestar(t.ventas(), OPCIONES)["predicciones_top10"]


# The same figures over the stand-in forecasts, where SQL can follow them.
vista("v_medidas", """
SELECT producto, COUNT(*) FILTER (WHERE "real" > 0) AS n_test,
  AVG(ABS("real" - prediccion)) FILTER (WHERE "real" > 0) AS mae_hibrido,
  AVG(2 * ABS("real" - prediccion) / (ABS("real") + ABS(prediccion) + 1e-8))
    FILTER (WHERE "real" > 0) * 100 AS smape_hibrido,
  AVG(ABS("real" - prophet)) AS mae_prophet,
  AVG(ABS("real" - prophet)) FILTER (WHERE "real" > 0) AS mae_prophet_activas,
  AVG(ABS("real" - prophet)) - AVG(ABS("real" - prediccion)) FILTER (WHERE "real" > 0)
    AS mejora_mae,
  AVG(ABS("real" - prophet)) FILTER (WHERE "real" > 0)
    - AVG(ABS("real" - prediccion)) FILTER (WHERE "real" > 0) AS mejora_mismas_filas,
  STDDEV_POP("real" - prediccion) FILTER (WHERE "real" > 0) AS std_residual
FROM v_historial GROUP BY producto""", "v_historial")


@consulta("met_holdout", "SELECT * FROM v_medidas",
          dobles="mae_hibrido:6 smape_hibrido:6 mae_prophet:6 mae_prophet_activas:6 mejora_mae:6 "
                 "mejora_mismas_filas:6 std_residual:6")
def _(t):
    return bo.met_holdout(t.historial())


@consulta("ts_resumen", """
SELECT producto, n_semanas, fecha AS fecha_proxima_semana, prediccion, prediccion * 0.5
         AS prophet_solo, CAST(format('{:.2f}', mae_hibrido) AS DOUBLE) AS mae_hibrido,
       CAST(format('{:.3f}', smape_hibrido) AS DOUBLE) AS smape_hibrido,
       CAST(format('{:.2f}', mae_prophet) AS DOUBLE) AS mae_prophet,
       CAST(format('{:.2f}', mejora_mae) AS DOUBLE) AS mejora_mae,
       CAST(format('{:.2f}', std_residual) AS DOUBLE) AS std_residual
FROM v_medidas JOIN v_pronostico USING (producto)
JOIN (SELECT producto, COUNT(*) AS n_semanas FROM v_serie GROUP BY 1) s USING (producto)
WHERE semana_offset = 1""")
def _(t):
    cuatro = t.pronostico().withColumn("prophet_solo", F.col("prediccion") * 0.5)
    return ts_resumen(ps.serie(t), cuatro, bo.met_holdout(t.historial()))


# Percentile and count rules of the multi-step back-test, over two stand-in steps.
@consulta("cuantiles_h", """
SELECT producto, h AS semana_offset,
       CASE WHEN COUNT(e) >= 3 THEN QUANTILE_CONT(e, 0.8) END AS p80
FROM (SELECT producto, 1 AS h, CASE WHEN "real" > 0 THEN ABS("real" - prediccion) END AS e
      FROM v_historial UNION ALL
      SELECT producto, 2, CASE WHEN "real" > 0 THEN ABS("real" - prophet) END FROM v_historial) x
GROUP BY producto, h""", dobles="p80:6")
def _(t):
    h = t.historial()
    return bo.cuantiles_h(set_union(
        h.select("producto", F.lit(1).alias("h"), "real", "prediccion"),
        h.select("producto", F.lit(2).alias("h"), "real", F.col("prophet").alias("prediccion"))))
