"""Business panel queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from despensa.functions import metrics as m
from despensa.functions import numbers as num
from despensa.functions.dates import fec_lunes, fec_periodos
from despensa.functions.text import cat_plato
from despensa.operators import filters as f
from despensa.operators import panel as p
from despensa.operators import recuentos as rc
from despensa.operators.joins import set_union
from despensa.plans.bindings import vista
from despensa.plans.registro import consulta
from despensa.soporte import cortar

# Dish-type rules over the words of the test tables' product names; the order decides, since
# "small ring" meets the first and the third rule.
REGLAS = [("Ligero", ["small", "blue"]), ("Fijacion", ["bolt", "rod"]),
          ("Giro", ["gear", "ring", "widget"]), ("Plano", ["plate"])]
TIPO_SQL = """CASE WHEN contains(lower(Nombre), 'small') OR contains(lower(Nombre), 'blue') THEN 'Ligero'
  WHEN contains(lower(Nombre), 'bolt') OR contains(lower(Nombre), 'rod') THEN 'Fijacion'
  WHEN regexp_matches(lower(Nombre), 'gear|ring|widget') THEN 'Giro'
  WHEN contains(lower(Nombre), 'plate') THEN 'Plano' ELSE 'Otros' END"""
vista("v_panel", f"SELECT *, {TIPO_SQL} AS TipoPlato, strftime(Fecha, '%Y-%m') AS Mes FROM v_ventas",
      "v_ventas")
vista("v_precios", """
SELECT Nombre AS producto, SUM(Precio * Cantidad) / GREATEST(SUM(Cantidad), 1) AS precio_unitario
FROM v_ventas GROUP BY Nombre""", "v_ventas")
vista("v_ingreso", """
SELECT f.*, COALESCE(precio_unitario, 0) AS precio_unitario,
       prediccion * COALESCE(precio_unitario, 0) AS ingreso,
       prediccion_lower * COALESCE(precio_unitario, 0) AS ingreso_lower,
       prediccion_upper * COALESCE(precio_unitario, 0) AS ingreso_upper
FROM v_pronostico f LEFT JOIN v_precios USING (producto)""", "v_pronostico", "v_precios")
vista("v_error", 'SELECT *, ABS("real" - prediccion) AS error_abs, '
                 'ABS("real" - prophet) AS error_base FROM v_historial', "v_historial")

ASOF = dt.date(2001, 11, 5)


def _panel(t):
    return t.ventas().withColumn("TipoPlato", cat_plato("Nombre", REGLAS))


def _precios(t):
    return p.agg_precio(t.ventas())


@consulta("cat_plato", "SELECT TipoPlato, COUNT(*) AS lineas, COUNT(DISTINCT Nombre) AS nombres "
                       "FROM v_panel GROUP BY TipoPlato")
def _(t):
    return _panel(t).groupBy("TipoPlato").agg(F.count(F.lit(1)).alias("lineas"),
                                              F.count_distinct("Nombre").alias("nombres"))


@consulta("fec_periodos", """
SELECT strftime(Fecha, '%Y-%m') AS Mes, strftime(date_trunc('week', Fecha), '%Y-%m-%d') AS Semana,
       strftime(Fecha, '%Y-%m-%d') AS Dia, dayname(Fecha) AS DiaSemana,
       CAST(year(Fecha) AS INTEGER) AS Anio, COUNT(*) AS lineas
FROM v_ventas GROUP BY ALL""")
def _(t):
    # Counted by date first: the text columns are made once per day, not once per line.
    d = t.ventas().groupBy("Fecha").agg(F.count(F.lit(1)).alias("lineas"))
    return d.withColumns(fec_periodos("Fecha")).drop("Fecha")


@consulta("fec_lunes", """
SELECT CAST(date_trunc('week', Fecha) AS DATE) AS ds, MIN(Fecha) AS primero, MAX(Fecha) AS ultimo,
       COUNT(*) AS lineas FROM v_ventas GROUP BY 1""")
def _(t):
    return t.ventas().groupBy(fec_lunes("Fecha").alias("ds")).agg(
        F.min("Fecha").alias("primero"), F.max("Fecha").alias("ultimo"),
        F.count(F.lit(1)).alias("lineas"))


def _gran(clave, grano, expr, valor, agg, por=None):
    """One entry per period, measure and second key the panel offers."""
    fun = {"sum": "SUM({})", "mean": "AVG({})", "nunique": "COUNT(DISTINCT {})"}[agg].format(valor)
    extra = f"{por}, " if por else ""
    donde = f" WHERE {por} IS NOT NULL" if por else ""
    sql = (f"SELECT {expr} AS Periodo, {extra}{fun} AS {valor} FROM v_panel{donde} GROUP BY ALL")

    @consulta(clave, sql, dobles="" if agg == "nunique" else valor)
    def _(t):
        return p.agg_granularidad(_panel(t), valor, grano, por, agg)


_gran("agg_granularidad", "Semana", "strftime(date_trunc('week', Fecha), '%Y-%m-%d')", "Total",
      "sum", "TipoPlato")
_gran("agg_granularidad_dia", "Dia", "strftime(Fecha, '%Y-%m-%d')", "Cantidad", "mean")
_gran("agg_granularidad_facturas", "Mes", "Mes", "Consecutivo", "nunique", "TipoPlato")
_gran("agg_mes_local", "Mes", "Mes", "Total", "sum", "Establecimiento")


@consulta("agg_mes", """
SELECT 'ventas' AS origen, Mes AS Periodo, SUM(Total) AS Total FROM v_panel GROUP BY Mes
UNION ALL
SELECT 'compras', strftime(Fecha, '%Y-%m'), SUM(Valor) FROM v_costos GROUP BY 2""", dobles="Total")
def _(t):
    v = p.agg_mes(t.ventas(), "Total").withColumn("origen", F.lit("ventas"))
    c = p.agg_mes(t.costos(), "Valor").withColumnRenamed("Valor", "Total")
    return v.unionByName(c.withColumn("origen", F.lit("compras")))


MARGEN = """
SELECT COALESCE(i.Periodo, c.Periodo) AS Periodo, COALESCE(Ingresos, 0) AS Ingresos,
       COALESCE(Costos, 0) AS Costos, COALESCE(Ingresos, 0) - COALESCE(Costos, 0) AS Margen
FROM (SELECT {v} AS Periodo, SUM(Total) AS Ingresos FROM v_ventas GROUP BY 1) i
FULL JOIN (SELECT {v} AS Periodo, SUM(Valor) AS Costos FROM v_costos GROUP BY 1) c
  ON i.Periodo = c.Periodo"""
SEMANA = "strftime(date_trunc('week', Fecha), '%Y-%m-%d')"


@consulta("jn_margen", MARGEN.format(v=SEMANA), dobles="Ingresos Costos Margen")
def _(t):
    return p.jn_margen(t.ventas(), t.costos(), "Semana")


@consulta("agg_utilidad", "SELECT Periodo, Ingresos AS Total_ventas, Costos AS Total_compras, "
          "Margen AS Utilidad FROM (" + MARGEN.format(v="strftime(Fecha, '%Y-%m')") + ") m",
          dobles="Total_ventas Total_compras Utilidad")
def _(t):
    return p.agg_utilidad(t.ventas(), t.costos())


@consulta("win_crec", """
SELECT Periodo AS mes, (Total - previo) / previo * 100 AS crec_mes FROM (
  SELECT Mes AS Periodo, SUM(Total) AS Total, LAG(SUM(Total)) OVER (ORDER BY Mes) AS previo
  FROM v_panel GROUP BY Mes) m
ORDER BY Periodo DESC LIMIT 1""", dobles="crec_mes:6")
def _(t):
    return p.win_crec(t.ventas())


@consulta("agg_kpi", """
SELECT ingresos, n_fact, unidades, ticket_prom, total_gasto, ingresos - total_gasto AS margen,
       CASE WHEN ingresos > 0 THEN (ingresos - total_gasto) / ingresos * 100 ELSE 0 END
         AS margen_pct
FROM (SELECT SUM(t) AS ingresos, COUNT(*) AS n_fact, SUM(q) AS unidades, AVG(t) AS ticket_prom
      FROM (SELECT Consecutivo, SUM(Total) AS t, SUM(Cantidad) AS q FROM v_ventas GROUP BY 1) f) k,
     (SELECT SUM(Valor) AS total_gasto FROM v_costos) g""",
          dobles="ingresos:2 unidades ticket_prom total_gasto:2 margen:2 margen_pct:6")
def _(t):
    return p.agg_kpi(t.ventas(), t.costos())


@consulta("agg_tipo", """
SELECT TipoPlato, Ingresos, Unidades, Facturas, Ingresos / SUM(Ingresos) OVER () * 100
         AS Participacion, Ingresos / NULLIF(Facturas, 0) AS TicketProm
FROM (SELECT TipoPlato, SUM(Total) AS Ingresos, SUM(Cantidad) AS Unidades,
             COUNT(DISTINCT Consecutivo) AS Facturas FROM v_panel GROUP BY 1) t""",
          dobles="Ingresos:2 Unidades Participacion:6 TicketProm")
def _(t):
    return p.agg_tipo(_panel(t))


@consulta("num_participacion", """
SELECT Establecimiento, Ingresos / SUM(Ingresos) OVER () * 100 AS Participacion,
       Ingresos / NULLIF(Impuesto, 0) AS por_impuesto
FROM (SELECT Establecimiento, SUM(Total) AS Ingresos, SUM(Impuesto) AS Impuesto FROM v_ventas
      WHERE Establecimiento IS NOT NULL GROUP BY 1) t""",
          dobles="Participacion:6 por_impuesto:6")
def _(t):
    from pyspark.sql import Window
    v = t.ventas().filter("Establecimiento IS NOT NULL").groupBy("Establecimiento").agg(
        F.sum("Total").alias("i"), F.sum("Impuesto").alias("x"))
    todo = F.sum("i").over(Window.partitionBy(F.lit(1)))
    return v.select("Establecimiento", num.num_participacion("i", todo).alias("Participacion"),
                    num.num_participacion("i", "x", 1.0).alias("por_impuesto"))


@consulta("num_escala", "SELECT Mes, SUM(Total) / 1e6 AS Millones, SUM(Cantidad) / 1 AS Unidades "
                        "FROM v_panel GROUP BY Mes", dobles="Millones:6 Unidades")
def _(t):
    return (t.ventas().groupBy(p.periodo("Fecha", "Mes").alias("Mes"))
            .agg(F.sum("Total").alias("t"), F.sum("Cantidad").alias("q"))
            .select("Mes", num.num_escala("t", 1e6).alias("Millones"),
                    num.num_escala("q", 1).alias("Unidades")))


DETALLE = """
SELECT Nombre, TipoPlato, SUM(Total) AS Ingresos, SUM(Cantidad) AS Unidades,
       COUNT(DISTINCT Consecutivo) AS Facturas, AVG(Precio) AS Precio_prom
FROM v_panel GROUP BY Nombre, TipoPlato"""


@consulta("agg_top", DETALLE + " ORDER BY Ingresos DESC, Nombre LIMIT 12",
          dobles="Ingresos Unidades Precio_prom")
def _(t):
    return p.agg_top(t.ventas(), 12, REGLAS)


@consulta("agg_detalle", f"SELECT *, Ingresos / SUM(Ingresos) OVER () * 100 AS Pct FROM ({DETALLE}) d",
          dobles="Ingresos Unidades Precio_prom Pct:6")
def _(t):
    return p.agg_detalle(t.ventas(), REGLAS)


@consulta("agg_dia", """
SELECT CAST(d.n AS INTEGER) AS n, d.DiaSemana, d.Dia, Ingresos, Facturas FROM (VALUES
  (0, 'Monday', 'Lun'), (1, 'Tuesday', 'Mar'), (2, 'Wednesday', 'Mie'), (3, 'Thursday', 'Jue'),
  (4, 'Friday', 'Vie'), (5, 'Saturday', 'Sab'), (6, 'Sunday', 'Dom')) d(n, DiaSemana, Dia)
LEFT JOIN (SELECT isodow(Fecha) - 1 AS n, SUM(Total) AS Ingresos,
                  COUNT(DISTINCT Consecutivo) AS Facturas
           FROM v_ventas GROUP BY 1) v ON v.n = d.n""", dobles="Ingresos:2")
def _(t):
    return p.agg_dia(t.ventas())


MESES = [f"{a}-{m:02d}" for a in range(1995, 2002) for m in range(1, 13)][:83]


@consulta("agg_pivote", "SELECT CASE isodow(Fecha) WHEN 1 THEN 'Lun' WHEN 2 THEN 'Mar' "
          "WHEN 3 THEN 'Mie' WHEN 4 THEN 'Jue' WHEN 5 THEN 'Vie' WHEN 6 THEN 'Sab' "
          "ELSE 'Dom' END AS Dia, "
          + ", ".join(f"COALESCE(SUM(CASE WHEN Mes = '{x}' THEN Total END), 0) AS \"{x}\""
                      for x in MESES) + " FROM v_panel GROUP BY 1",
          dobles=" ".join(MESES))
def _(t):
    return p.agg_pivote(t.ventas())


@consulta("agg_proveedor", "SELECT Proveedor, SUM(Valor) AS Valor FROM v_costos GROUP BY 1 "
                           "ORDER BY Valor DESC, Proveedor LIMIT 10", dobles="Valor:2")
def _(t):
    return p.agg_proveedor(t.costos())


@consulta("agg_semana", "SELECT * FROM v_semanal", dobles="y")
def _(t):
    return p.agg_semana(t.ventas())


@consulta("agg_precio", """
SELECT producto, CASE WHEN n > 0 THEN pr / GREATEST(qr, 1) ELSE p / GREATEST(q, 1) END
         AS precio_unitario
FROM (SELECT Nombre AS producto, COUNT(*) FILTER (WHERE r) AS n,
             SUM(Precio * Cantidad) FILTER (WHERE r) AS pr, SUM(Cantidad) FILTER (WHERE r) AS qr,
             SUM(Precio * Cantidad) AS p, SUM(Cantidad) AS q
      FROM (SELECT *, Fecha >= (SELECT MAX(Fecha) FROM v_ventas) - 90 AS r FROM v_ventas) x
      GROUP BY 1) y""", dobles="precio_unitario")
def _(t):
    return p.agg_precio(t.ventas(), 90)


@consulta("agg_precio_historia", "SELECT * FROM v_precios", dobles="precio_unitario")
def _(t):
    return _precios(t)


@consulta("agg_tendencia", """
SELECT Periodo, Total, CASE WHEN COUNT(*) OVER () > 3 THEN
         regr_intercept(Total, i) OVER () + regr_slope(Total, i) OVER () * i END AS tendencia
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY Periodo) - 1 AS i FROM (
        SELECT Mes AS Periodo, SUM(Total) AS Total FROM v_panel GROUP BY Mes) a) b""",
          dobles="Total tendencia")
def _(t):
    return p.agg_tendencia(p.agg_mes(t.ventas(), "Total"), "Total")


@consulta("jn_ingreso", "SELECT * FROM v_ingreso",
          dobles="prediccion prediccion_lower prediccion_upper precio_unitario ingreso "
                 "ingreso_lower ingreso_upper")
def _(t):
    return p.jn_ingreso(t.pronostico(), _precios(t))


@consulta("agg_ingreso_sem", """
SELECT semana_offset, fecha, confianza_pct, SUM(ingreso) AS ingreso,
       SUM(ingreso_lower) AS ingreso_lower, SUM(ingreso_upper) AS ingreso_upper
FROM v_ingreso GROUP BY 1, 2, 3""", dobles="ingreso ingreso_lower ingreso_upper")
def _(t):
    return p.agg_ingreso_sem(p.jn_ingreso(t.pronostico(), _precios(t)))


@consulta("agg_plan4", "SELECT producto, SUM(prediccion) AS unidades_total, "
                       "SUM(ingreso) AS ingreso_total FROM v_ingreso GROUP BY 1",
          dobles="unidades_total ingreso_total")
def _(t):
    return p.agg_plan4(t.pronostico(), _precios(t))


@consulta("cat_confianza", """
SELECT producto, semana_offset, confianza_pct,
       CASE WHEN confianza_pct >= 70 THEN 'alta' WHEN confianza_pct >= 50 THEN 'media'
            ELSE 'baja' END AS nivel FROM v_pronostico""")
def _(t):
    return t.pronostico().select("producto", "semana_offset", "confianza_pct",
                                 num.cat_confianza("confianza_pct").alias("nivel"))


# Forecasts shifted one week, so some of them meet a sold week and some do not.
vista("v_seguimiento", """
SELECT f.producto, f.fecha, f.prediccion, CASE WHEN s.y > 0 THEN CAST(floor(s.y) AS BIGINT) END
         AS "real", CASE WHEN s.y > 0 THEN ABS(s.y - f.prediccion) END AS error
FROM (SELECT producto, fecha + 7 AS fecha, prediccion FROM v_pronostico) f
LEFT JOIN v_semanal s ON s.producto = f.producto AND s.ds = f.fecha
WHERE f.fecha < DATE '2001-11-05'""", "v_pronostico", "v_semanal")


def _seguimiento(t):
    corrido = t.pronostico().withColumn("fecha", F.date_add("fecha", 7))
    return p.jn_seguimiento(corrido, t.ventas(), F.lit(ASOF))


@consulta("jn_seguimiento", "SELECT * FROM v_seguimiento", dobles="prediccion error")
def _(t):
    return _seguimiento(t)


@consulta("agg_mae_vivo", "SELECT AVG(error) AS mae_vivo, COUNT(error) AS semanas "
                          "FROM v_seguimiento", dobles="mae_vivo:6")
def _(t):
    return p.agg_mae_vivo(_seguimiento(t))


@consulta("flt_pasadas", "SELECT * FROM v_pronostico WHERE fecha < DATE '2001-10-22'",
          dobles="prediccion prediccion_lower prediccion_upper")
def _(t):
    return f.flt_pasadas(t.pronostico(), F.lit(dt.date(2001, 10, 22)))


@consulta("cat_alias", """
SELECT CASE WHEN Nombre IN ('old plate', 'new plate') THEN 'plate (combinado)' ELSE Nombre END
         AS Nombre, CAST(date_trunc('week', Fecha) AS DATE) AS ds, SUM(Cantidad) AS y
FROM v_ventas GROUP BY 1, 2""", dobles="y")
def _(t):
    from despensa.functions.text import cat_alias
    v = t.ventas().withColumn("Nombre", cat_alias("Nombre", ["old plate", "new plate"],
                                                  "plate (combinado)"))
    return p.agg_semana(v).withColumnRenamed("producto", "Nombre")


@consulta("met_error_sem", "SELECT * FROM v_error",
          dobles="real prediccion prophet error_abs error_base")
def _(t):
    return p.met_error_sem(t.historial())


@consulta("agg_prec_prod", """
SELECT producto, AVG(error_abs) AS mae, MAX(error_abs) AS error_max,
       MEDIAN(error_abs) AS error_mediano, COUNT(error_abs) AS semanas
FROM v_error GROUP BY 1""", dobles="mae:6 error_max error_mediano")
def _(t):
    return p.agg_prec_prod(t.historial())


@consulta("agg_prec_sem", """
SELECT ds, SUM("real") AS "real", SUM(prediccion) AS prediccion, SUM(error_abs) AS error_abs,
       SUM(prophet) AS prophet FROM v_error GROUP BY 1""",
          dobles="real prediccion error_abs prophet")
def _(t):
    return p.agg_prec_sem(t.historial())


COLA = """SELECT * EXCLUDE (n, k) FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY ds DESC, md5(producto), producto) AS n,
         (SELECT COUNT(DISTINCT producto) * 4 FROM v_historial) AS k FROM v_error) x
WHERE n <= k"""


@consulta("win_cola", COLA, dobles="real prediccion prophet error_abs error_base")
def _(t):
    h = t.historial()
    return p.win_cola(p.met_error_sem(h), h.select(F.count_distinct("producto") * 4).scalar())


@consulta("agg_prec_kpi", f"""
SELECT AVG(error_abs) AS mae_total,
       AVG(CASE WHEN error_abs <= (SELECT AVG(error_abs) FROM v_error) THEN 1.0 ELSE 0 END) * 100
         AS pct_bien,
       (SELECT AVG(error_abs) FROM ({COLA}) c) AS mae_ult4
FROM v_error""", dobles="mae_total:6 pct_bien:6 mae_ult4:6")
def _(t):
    return p.agg_prec_kpi(t.historial())


def _metrica(clave, expr, medida):
    @consulta(clave, f"SELECT producto, {expr} AS valor FROM v_historial GROUP BY producto",
              dobles="valor:6")
    def _(t):
        return t.historial().groupBy("producto").agg(medida("real", "prediccion").alias("valor"))


_metrica("met_mae", 'AVG(ABS("real" - prediccion))', m.met_mae)
_metrica("met_rmse", 'SQRT(AVG(("real" - prediccion) * ("real" - prediccion)))', m.met_rmse)
_metrica("met_mape", 'COALESCE(AVG(ABS("real" - prediccion) / "real") FILTER (WHERE "real" <> 0) '
                     '* 100, 0)', m.met_mape)
_metrica("met_smape", 'AVG(2 * ABS("real" - prediccion) / (ABS("real") + ABS(prediccion) + 1e-8)) '
                      '* 100', m.met_smape)
_metrica("met_sesgo", 'AVG(prediccion - "real")', m.met_sesgo)
_metrica("met_activas", 'AVG(ABS("real" - prediccion)) FILTER (WHERE "real" > 0)',
         lambda y, p: m.met_activas(m.met_mae, y, p))


@consulta("met_mejora", """
SELECT producto, AVG(ABS("real" - prophet)) AS mae_base,
       AVG(ABS("real" - prediccion)) FILTER (WHERE "real" > 0) AS mae_hibrido,
       AVG(ABS("real" - prophet))
         - AVG(ABS("real" - prediccion)) FILTER (WHERE "real" > 0) AS mejora_mae,
       AVG(ABS("real" - prophet)) FILTER (WHERE "real" > 0)
         - AVG(ABS("real" - prediccion)) FILTER (WHERE "real" > 0) AS mejora_mismas_filas
FROM v_historial GROUP BY producto""",
          dobles="mae_base:6 mae_hibrido:6 mejora_mae:6 mejora_mismas_filas:6")
def _(t):
    return t.historial().groupBy("producto").agg(
        m.met_mae("real", "prophet").alias("mae_base"), m.met_activas(m.met_mae, "real", "prediccion").alias("mae_hibrido"),
        m.met_mejora("real", "prophet", "prediccion").alias("mejora_mae"),
        m.met_mejora("real", "prophet", "prediccion", mismas_filas=True).alias("mejora_mismas_filas"))


@consulta("agg_promedios", """
SELECT AVG(mae) AS mae, AVG(smape) AS smape, AVG(sesgo) AS sesgo FROM (
  SELECT producto, AVG(ABS("real" - prediccion)) AS mae,
         AVG(2 * ABS("real" - prediccion) / (ABS("real") + ABS(prediccion) + 1e-8)) AS smape,
         AVG(prediccion - "real") AS sesgo
  FROM v_historial GROUP BY producto) x""", dobles="mae:6 smape:6 sesgo:6")
def _(t):
    por = t.historial().groupBy("producto").agg(
        m.met_mae("real", "prediccion").alias("mae"), m.met_smape("real", "prediccion", 1.0).alias("smape"),
        m.met_sesgo("real", "prediccion").alias("sesgo"))
    return por.agg(*[F.avg(c).alias(c) for c in ("mae", "smape", "sesgo")])


# ---- stored days: any stretch of dates without the ledger ----

TRAMOS_SQL = "(VALUES " + ", ".join(
    f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in (
        ("todo", "1990-01-01", "2010-01-01"), ("un dia", "1997-03-03", "1997-03-03"), ("trimestre", "1997-04-01", "1997-06-30"),
        ("nada", "2009-01-01", "2009-12-31"))) + ") r(tramo, desde, hasta)"
TRAMOS = {"todo": (None, None), "un dia": ("1997-03-03", "1997-03-03"), "trimestre": ("1997-04-01", "1997-06-30"),
          "nada": ("2009-01-01", "2009-12-31")}


@consulta("agg_recuento", f"""
SELECT tramo, dim, valor, Ingresos, Unidades, Facturas FROM (
  SELECT tramo, 'TipoPlato' AS dim, TipoPlato AS valor, SUM(Total) AS Ingresos, SUM(Cantidad) AS Unidades,
    COUNT(DISTINCT Consecutivo) AS Facturas
  FROM v_panel JOIN {TRAMOS_SQL} ON Fecha BETWEEN desde AND hasta GROUP BY 1, 2, 3
  UNION ALL
  SELECT tramo, 'dia', CAST(isodow(Fecha) - 1 AS VARCHAR), SUM(Total), SUM(Cantidad), COUNT(DISTINCT Consecutivo)
  FROM v_panel JOIN {TRAMOS_SQL} ON Fecha BETWEEN desde AND hasta GROUP BY 1, 2, 3
  UNION ALL
  SELECT tramo, 'kpi', NULL, SUM(Total), SUM(Cantidad), COUNT(DISTINCT Consecutivo)
  FROM v_panel JOIN {TRAMOS_SQL} ON Fecha BETWEEN desde AND hasta GROUP BY 1, 2) x""",
          dobles="Ingresos:2 Unidades")
def _(t):
    v = cortar(_panel(t))
    dias = cortar(rc.agg_recuento(v, rc.numerar(v), "TipoPlato"))
    partes = []
    for tramo, (a, b) in TRAMOS.items():
        for dim, valor in (("TipoPlato", F.col("TipoPlato")), ("dia", F.weekday("Fecha").cast("string")),
                           ("kpi", F.lit(None).cast("string"))):
            partes.append(rc.recuento(dias, valor.alias("valor"), desde=a, hasta=b).select(
                F.lit(tramo).alias("tramo"), F.lit(dim).alias("dim"), "valor", "Ingresos", "Unidades", "Facturas"))
    return set_union(*partes)
