"""Weekly series, features, splits and diagnostics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from despensa.operators import diagnostics as dg
from despensa.operators import filters as f
from despensa.operators import panel as p
from despensa.operators import series as s
from despensa.plans.bindings import DESPLAZAMIENTO, vista
from despensa.plans.calendario import MARCAS
from despensa.plans.registro import consulta
from despensa.soporte import cortar

V = "OVER (PARTITION BY producto ORDER BY ds)"
CIERRE = "ds BETWEEN DATE '1996-10-01' AND DATE '1996-12-31'"
vista("v_abierta", f"SELECT * FROM v_serie WHERE NOT ({CIERRE})", "v_serie")


def _roll(k: int) -> str:
    r = f"(PARTITION BY producto ORDER BY ds ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN COUNT(y) OVER {r} = {k} THEN AVG(y) OVER {r} END AS rolling_{k}"


vista("v_features", f"""
SELECT *, CASE WHEN lag_1 = 0 AND semana_academica IN (1, 2)
               THEN AVG(y) OVER (PARTITION BY producto, semana_academica) ELSE lag_1 END
            AS lag_1_clean,
       lag_1 * inicio_parciales_1 AS lag_x_parciales
FROM (SELECT producto, ds, y, a.semana_academica, h.* EXCLUDE (ds),
        CAST(month(ds) AS INTEGER) AS mes, CAST(weekofyear(ds) AS INTEGER) AS semana_anio,
        CAST(quarter(ds) AS INTEGER) AS trimestre,
        CASE WHEN quarter(ds) <= 2 THEN 1 ELSE 2 END AS semestre,
        sin(2 * pi() * month(ds) / 12) AS mes_sin, cos(2 * pi() * month(ds) / 12) AS mes_cos,
        sin(2 * pi() * weekofyear(ds) / 52) AS semana_sin,
        cos(2 * pi() * weekofyear(ds) / 52) AS semana_cos, {MARCAS},
        CAST(CASE WHEN DATE '1996-06-02' > ds
             THEN GREATEST(0, 4 - (DATE '1996-06-02' - ds) // 7) ELSE 0 END AS INTEGER)
          AS semanas_antes_verano,
        LAG(y, 1) {V} AS lag_1, LAG(y, 2) {V} AS lag_2, LAG(y, 4) {V} AS lag_4,
        LAG(y, 52) {V} AS lag_52, {_roll(4)}, {_roll(8)},
        CAST(COALESCE(LEAD(semana_academica) {V} = 0, false) AS INTEGER) AS pre_evento,
        CAST(semana_academica = 1 OR COALESCE(LAG(semana_academica) {V} = -1, false) AS INTEGER)
          AS post_vacaciones
      FROM v_abierta s JOIN v_acad a USING (ds) JOIN v_hol h USING (ds)) x""",
      "v_abierta", "v_acad", "v_hol")


def serie(t):
    return s.ts_serie(t.ventas())


def abierta(t):
    return f.flt_cierre(serie(t), dias_atras=DESPLAZAMIENTO)


def features(t, sin_fuga: bool = False):
    """Features of the open weeks; the date range comes off the file's date column."""
    ini, fin = t.t("lineitem").agg(F.min("l_shipdate").cast("date"),
                                   F.max("l_shipdate").cast("date")).first()
    return s.ts_features(abierta(t), ini, fin, DESPLAZAMIENTO, sin_fuga)


@consulta("ts_serie", "SELECT * FROM v_serie", dobles="y")
def _(t):
    return serie(t)


@consulta("jn_calendario", """
SELECT producto, COUNT(*) AS semanas, MIN(ds) AS desde, MAX(ds) AS hasta, SUM(y) AS y
FROM v_serie GROUP BY producto""", dobles="y")
def _(t):
    return serie(t).groupBy("producto").agg(
        F.count(F.lit(1)).alias("semanas"), F.min("ds").alias("desde"), F.max("ds").alias("hasta"),
        F.sum("y").alias("y"))


@consulta("flt_cierre", "SELECT * FROM v_abierta", dobles="y")
def _(t):
    return abierta(t)


@consulta("flt_activas", "SELECT * FROM v_abierta WHERE y > 0", dobles="y")
def _(t):
    return f.flt_activas(abierta(t))


@consulta("agg_cobertura", """
SELECT producto, COUNT(*) AS semanas, COUNT(*) FILTER (WHERE y > 0) AS activas,
       COUNT(*) FILTER (WHERE y = 0) AS en_cero FROM v_abierta GROUP BY producto""")
def _(t):
    return p.agg_cobertura(abierta(t))


@consulta("set_expandir", """
SELECT producto, ds, y FROM v_abierta
UNION ALL
SELECT producto, u + 7 * CAST(k AS INTEGER), NULL
FROM (SELECT producto, MAX(ds) AS u FROM v_abierta GROUP BY 1) m, range(1, 5) r(k)""", dobles="y")
def _(t):
    return s.set_expandir(abierta(t), 4)


@consulta("ts_futuro", """
SELECT producto, u + 7 * CAST(k AS INTEGER) AS ds
FROM (SELECT producto, MAX(ds) AS u FROM v_abierta GROUP BY 1) m, range(1, 27) r(k)""")
def _(t):
    return s.ts_futuro(abierta(t), 26).filter("y IS NULL").select("producto", "ds")


@consulta("win_lags", f"SELECT producto, ds, y, LAG(y, 1) {V} AS lag_1, LAG(y, 2) {V} AS lag_2, "
                      f"LAG(y, 4) {V} AS lag_4, LAG(y, 52) {V} AS lag_52 FROM v_abierta",
          dobles="y lag_1 lag_2 lag_4 lag_52")
def _(t):
    return s.win_lags(abierta(t), (1, 2, 4, 52))


@consulta("win_rolling", f"SELECT producto, ds, y, {_roll(4)}, {_roll(8)} FROM v_abierta",
          dobles="y rolling_4:6 rolling_8:6")
def _(t):
    return s.win_rolling(abierta(t))


_REALES = ("y lag_1 lag_2 lag_4 lag_52 rolling_4:6 rolling_8:6 mes_sin:6 mes_cos:6 semana_sin:6 "
           "semana_cos:6 lag_1_clean:6 lag_x_parciales")


@consulta("ts_features", "SELECT * FROM v_features", dobles=_REALES)
def _(t):
    return features(t).drop("festivos")


def _parte(clave, cols, dobles="y"):
    @consulta(clave, f"SELECT producto, ds, {', '.join(cols)} FROM v_features", dobles=dobles)
    def _(t):
        return features(t).select("producto", "ds", *cols)


_parte("win_pre_evento", ["semana_academica", "pre_evento"], "")
_parte("win_post_vac", ["semana_academica", "post_vacaciones"], "")
_parte("win_lag_limpio", ["y", "lag_1", "semana_academica", "lag_1_clean"],
       "y lag_1 lag_1_clean:6")
_parte("fec_interaccion", ["lag_1", "inicio_parciales_1", "lag_x_parciales"],
       "lag_1 lag_x_parciales")


@consulta("agg_media_cond", """
SELECT producto, ds, semana_academica, AVG(y) OVER (PARTITION BY producto, semana_academica)
       AS media_semana FROM v_features""", dobles="media_semana:6")
def _(t):
    return s.agg_media_cond(features(t)).select("producto", "ds", "semana_academica",
                                                "media_semana")


# The inputs that come from the series and the calendar; yhat* needs a fitted baseline.
SIN_BASE = [c for c in s.FEATURES if not c.startswith("yhat")]


@consulta("flt_completas", "SELECT producto, ds, y FROM v_features WHERE "
          + " AND ".join(f"{c} IS NOT NULL" for c in SIN_BASE), dobles="y")
def _(t):
    return f.flt_completas(features(t), SIN_BASE).select("producto", "ds", "y")


@consulta("flt_minimos", """
SELECT producto, ds, y, CAST(NULL AS VARCHAR) AS error FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY producto) AS n FROM v_semanal) x WHERE n >= 330
UNION ALL
SELECT producto, NULL, NULL, 'serie muy corta' FROM v_semanal GROUP BY producto
HAVING COUNT(*) < 330""", dobles="y")
def _(t):
    # The bound that splits the test products; the forecast itself asks for 40 and 25 rows.
    w = t.semanal()
    largas = f.flt_minimos(w, 330).select("producto", "ds", "y",
                                          F.lit(None).cast("string").alias("error"))
    cortas = f.flt_cortas(w, 330, "serie muy corta").select(
        "producto", F.lit(None).cast("date").alias("ds"), F.lit(None).cast("double").alias("y"),
        "error")
    return largas.unionByName(cortas)


@consulta("win_corte", """
SELECT producto, ds, i, CASE WHEN i <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS parte,
       CASE WHEN i <= floor(0.65 * n) THEN 'train' WHEN i <= floor(0.8 * n) THEN 'val'
            ELSE 'test' END AS parte3
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i,
             COUNT(*) OVER (PARTITION BY producto) AS n FROM v_abierta) x""")
def _(t):
    dos = s.win_corte(abierta(t))
    return (s.win_corte(dos.select("producto", "ds", "y", F.col("parte").alias("dos")),
                        (0.65, 0.80), ("train", "val", "test"))
            .select("producto", "ds", F.col("i").cast("bigint").alias("i"),
                    F.col("dos").alias("parte"), F.col("parte").alias("parte3")))


@consulta("win_folds", """
SELECT producto, ds, CASE WHEN i > n - 3 * (n // 4)
       THEN CAST((i - 1 - (n - 3 * (n // 4))) // (n // 4) + 1 AS INTEGER) END AS pliegue
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i,
             COUNT(*) OVER (PARTITION BY producto) AS n FROM v_abierta) x""")
def _(t):
    return s.win_folds(abierta(t)).select("producto", "ds", "pliegue")


@consulta("flt_hist_fut", """
SELECT producto, ds, CASE WHEN ds <= DATE '2000-12-31' THEN 'historia' ELSE 'futuro' END AS tramo
FROM v_abierta""")
def _(t):
    return f.flt_hist_fut(abierta(t), F.lit(dt.date(2000, 12, 31))).select("producto", "ds",
                                                                          "tramo")


# ---- rows that stand in for a fitted baseline: last week's value and a four-week mean ----


@consulta("jn_pronostico", """
SELECT s.producto, s.ds, s.y, h.prophet AS yhat, h.prediccion
FROM v_serie s LEFT JOIN v_historial h USING (producto, ds)""", dobles="y yhat:6 prediccion")
def _(t):
    h = t.historial().select("producto", "ds", F.col("prophet").alias("yhat"), "prediccion")
    return serie(t).join(h, ["producto", "ds"], "left")


@consulta("jn_validacion", """
SELECT producto, AVG(ABS(y - prophet)) AS mae, COUNT(*) AS semanas FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i,
         COUNT(*) OVER (PARTITION BY producto) AS n FROM v_serie) s
JOIN v_historial h USING (producto, ds)
WHERE i > floor(0.8 * n) AND y > 0 GROUP BY producto""", dobles="mae:6")
def _(t):
    val = f.flt_activas(s.win_corte(serie(t)).filter("parte = 'test'"))
    h = t.historial().select("producto", "ds", "prophet")
    return val.join(h, ["producto", "ds"]).groupBy("producto").agg(
        F.avg(F.abs(F.col("y") - F.col("prophet"))).alias("mae"),
        F.count(F.lit(1)).alias("semanas"))


@consulta("ts_residuo", 'SELECT producto, ds, "real" - prophet AS residuo FROM v_historial',
          dobles="residuo:6")
def _(t):
    return s.ts_residuo(t.historial(), "real", "prophet").select("producto", "ds", "residuo")


@consulta("ts_cero", """
SELECT s.producto, s.ds, s.y, CASE WHEN s.y = 0 THEN 0 ELSE h.prophet END AS yhat
FROM v_serie s JOIN v_historial h USING (producto, ds)
UNION ALL
SELECT producto, ds, y, 0 FROM v_serie s WHERE y = 0
  AND NOT EXISTS (SELECT 1 FROM v_historial h WHERE h.producto = s.producto AND h.ds = s.ds)
UNION ALL
SELECT producto, ds, y, NULL FROM v_serie s WHERE y <> 0
  AND NOT EXISTS (SELECT 1 FROM v_historial h WHERE h.producto = s.producto AND h.ds = s.ds)""",
          dobles="y yhat:6")
def _(t):
    h = t.historial().select("producto", "ds", F.col("prophet").alias("yhat"))
    d = serie(t).join(h, ["producto", "ds"], "left")
    return s.ts_cero(d, F.col("y") == 0, ("yhat",))


@consulta("ts_confianza", """
SELECT producto, semana_offset, CAST(GREATEST(50, 80 - 7 * (semana_offset - 1)) AS INTEGER)
       AS confianza FROM v_pronostico""")
def _(t):
    from despensa.operators.horizon import ts_confianza
    return t.pronostico().select("producto", "semana_offset",
                                 ts_confianza("semana_offset").alias("confianza"))


vista("v_ancho", """
SELECT producto, CASE WHEN COUNT(*) >= 3 THEN QUANTILE_CONT(ABS("real" - prediccion), 0.8) END
         AS p80, STDDEV_POP("real" - prediccion) AS std_residual
FROM v_historial WHERE "real" > 0 GROUP BY producto""", "v_historial")


@consulta("ts_intervalo", """
SELECT producto, semana_offset, prediccion, GREATEST(0, prediccion - a) AS prediccion_lower,
       prediccion + a AS prediccion_upper
FROM (SELECT f.*, COALESCE(NULLIF(CASE WHEN semana_offset < 4 THEN p80 ELSE 0 END, 0),
                           std_residual * (1 + 0.15 * (semana_offset - 1))) AS a
      FROM v_pronostico f JOIN v_ancho USING (producto)) x""",
          dobles="prediccion prediccion_lower:6 prediccion_upper:6")
def _(t):
    from despensa.operators.horizon import percentil80, ts_intervalo
    error = F.col("real") - F.col("prediccion")
    ancho = t.historial().filter("real > 0").groupBy("producto").agg(
        percentil80(F.abs(error)).alias("p80"), F.stddev_pop(error).alias("std_residual"))
    # A zero width at the last week shows the fall-back to the residual spread.
    d = t.pronostico().join(ancho, "producto").withColumn(
        "p80", F.when(F.col("semana_offset") < 4, F.col("p80")).otherwise(0.0))
    return ts_intervalo(d).select("producto", "semana_offset", "prediccion", "prediccion_lower",
                                  "prediccion_upper")


@consulta("ts_seleccion", """
SELECT producto, ds, CASE WHEN mae_h < mae_p THEN prediccion ELSE prophet END AS elegida,
       CASE WHEN mae_h < mae_p THEN 'hibrido' ELSE 'base' END AS modelo
FROM v_historial JOIN (
  SELECT producto, AVG(ABS("real" - prediccion)) AS mae_h, AVG(ABS("real" - prophet)) AS mae_p
  FROM v_historial GROUP BY producto) m USING (producto)""", dobles="elegida:6")
def _(t):
    from despensa.operators.horizon import ts_seleccion
    h = cortar(t.historial())
    mae = h.groupBy("producto").agg(
        F.avg(F.abs(F.col("real") - F.col("prediccion"))).alias("mae_hibrido"),
        F.avg(F.abs(F.col("real") - F.col("prophet"))).alias("mae_base"))
    return ts_seleccion(h.join(mae, "producto"), "prediccion", "prophet").select(
        "producto", "ds", "elegida", "modelo")


# ---- diagnostics ----

vista("v_d", 'SELECT producto, ds, "real" - AVG("real") OVER (PARTITION BY producto) AS d '
             'FROM v_historial', "v_historial")
vista("v_r", """
SELECT a.producto, CAST(k AS INTEGER) AS lag, COUNT(DISTINCT a.ds) AS m,
       SUM(a.d * b.d) / ANY_VALUE(t.s0) AS r, ANY_VALUE(t.n) AS n
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i FROM v_d) a
CROSS JOIN range(0, 21) q(k)
JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS i FROM v_d) b
  ON b.producto = a.producto AND b.i = a.i - k
JOIN (SELECT producto, SUM(d * d) AS s0, COUNT(*) AS n FROM v_d GROUP BY 1) t
  ON t.producto = a.producto
GROUP BY a.producto, k""", "v_d")


@consulta("st_acf", """
SELECT producto, lag, r AS acf, CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * SQRT(
  (1 + 2 * COALESCE(SUM(CASE WHEN lag > 0 THEN r * r END) OVER (PARTITION BY producto ORDER BY lag
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END AS banda
FROM v_r""", dobles="acf:6 banda:6")
def _(t):
    return dg.st_acf(t.historial(), "real")


@consulta("st_pacf", """
, lista AS (SELECT producto, ANY_VALUE(n) AS n, LIST(r ORDER BY lag) FILTER (WHERE lag > 0) AS r
            FROM v_r GROUP BY producto),
pasos AS (
  SELECT producto, n, r, 1 AS k, [r[1]] AS phi, 1 - r[1] * r[1] AS v, r[1] AS f FROM lista
  UNION ALL
  SELECT producto, n, r, k + 1,
         list_append(list_transform(range(1, k + 1), lambda i: phi[i] - g * phi[k + 1 - i]), g),
         v * (1 - g * g), g
  FROM (SELECT *, (r[k + 1] - list_dot_product(phi, list_reverse(r[1:k]))) / v AS g FROM pasos
        WHERE k < LEAST(20, n - 1)) s)
SELECT producto, k AS lag, f AS pacf, 1.959963984540054 / SQRT(n) AS banda FROM pasos
UNION ALL SELECT producto, 0, 1, 1.959963984540054 / SQRT(n) FROM lista""",
          dobles="pacf:6 banda:6")
def _(t):
    return dg.st_pacf(t.historial(), "real")


vista("v_q", """
SELECT producto, lag, n * (n + 2) * SUM(r * r / (n - lag)) OVER (PARTITION BY producto ORDER BY lag)
         AS estadistico
FROM v_r WHERE lag BETWEEN 1 AND 15 AND lag <= n // 2 - 1""", "v_r")


# The tail is 1 minus the lower gamma series; the engine uses closed forms instead.
@consulta("st_ljung", """
SELECT producto, lag, estadistico, p_valor, p_valor < 0.05 AS significativo FROM (
  SELECT *, GREATEST(0, 1 - list_sum(list_transform(range(0, 1500),
    lambda j: exp((lag / 2.0 + j) * ln(estadistico / 2) - estadistico / 2
                  - lgamma(lag / 2.0 + j + 1))))) AS p_valor FROM v_q) x""",
          dobles="estadistico:6 p_valor:6")
def _(t):
    return dg.st_ljung(t.historial(), "real")


@consulta("st_ljung_resumen", """
SELECT producto, COUNT(*) FILTER (WHERE s) AS n_sig, COUNT(*) AS n_lags,
       COALESCE(list_sort(LIST(lag) FILTER (WHERE s)), []) AS lags
FROM (SELECT *, 1 - list_sum(list_transform(range(0, 1500),
    lambda j: exp((lag / 2.0 + j) * ln(estadistico / 2) - estadistico / 2
                  - lgamma(lag / 2.0 + j + 1)))) < 0.05 AS s FROM v_q) x GROUP BY producto""")
def _(t):
    return dg.st_ljung_resumen(dg.st_ljung(t.historial(), "real"))
