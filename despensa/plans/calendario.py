"""Calendar queries: the calendar of 2024-2026 moved to the test tables' years, over sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from despensa.functions import dates as fd
from despensa.operators import calendar as oc
from despensa.operators import filters as f
from despensa.plans.bindings import DESPLAZAMIENTO, vista
from despensa.plans.registro import consulta
from despensa.soporte import cortar
from despensa.sources import calendar as cal

_valores = ",\n  ".join(f"({i}, '{h}', DATE '{a}', DATE '{b}')"
                        for i, (h, a, b) in enumerate(cal.BLOQUES))
vista("v_bloques", f"""
SELECT ord, holiday, ini - {DESPLAZAMIENTO} AS ini, fin - {DESPLAZAMIENTO} AS fin FROM (VALUES
  {_valores}) b(ord, holiday, ini, fin)""")
vista("v_cal", """
SELECT holiday, CAST(unnest(generate_series(ini, fin, INTERVAL 1 DAY)) AS DATE) AS ds, ord
FROM v_bloques""", "v_bloques")
vista("v_inicios", "SELECT inicio - %d AS inicio FROM (VALUES %s) i(inicio)" % (
    DESPLAZAMIENTO, ", ".join(f"(DATE '{d}')" for d in cal.INICIOS)))
vista("v_etiqueta", "SELECT ds, arg_max(holiday, ord) AS etiqueta FROM v_cal GROUP BY ds", "v_cal")
vista("v_semanas", "SELECT DISTINCT ds FROM v_serie", "v_serie")
vista("v_acad", """
SELECT s.ds, e.etiqueta, (SELECT MAX(inicio) FROM v_inicios WHERE inicio <= s.ds) AS inicio,
  CAST(CASE WHEN s.ds IN (SELECT inicio FROM v_inicios) THEN 1
    WHEN e.etiqueta LIKE '%finales%' THEN 17
    WHEN regexp_matches(e.etiqueta, 'receso|santa|induccion') THEN 0
    WHEN e.etiqueta LIKE '%vacaciones%' THEN -1
    WHEN NOT EXISTS (SELECT 1 FROM v_inicios WHERE inicio <= s.ds) THEN 0
    ELSE (SELECT COUNT(*) FROM v_semanas l LEFT JOIN v_etiqueta le ON le.ds = l.ds
          WHERE l.ds <= s.ds AND l.ds >= (SELECT MAX(inicio) FROM v_inicios WHERE inicio <= s.ds)
            AND NOT COALESCE(regexp_matches(le.etiqueta, 'receso|santa|finales|induccion'), false))
  END AS INTEGER) AS semana_academica
FROM v_semanas s LEFT JOIN v_etiqueta e ON e.ds = s.ds""", "v_semanas", "v_etiqueta", "v_inicios")
vista("v_hol", "SELECT s.ds, " + ", ".join(
    f"CAST(MAX(CASE WHEN c.holiday = '{h}' THEN 1 ELSE 0 END) AS INTEGER) AS hol_{h}"
    for h in cal.NOMBRES) + " FROM v_semanas s LEFT JOIN v_cal c ON c.ds >= s.ds "
    "AND c.ds < s.ds + 7 GROUP BY s.ds", "v_semanas", "v_cal")


def _ventas_dia(t):
    return t.ventas().groupBy(F.col("Fecha").alias("ds")).agg(F.sum("Cantidad").alias("unidades"))


def _semanal(t):
    """Weekly sums, stored, and the weeks they span."""
    s = cortar(t.semanal())
    return s, *s.agg(F.min("ds"), F.max("ds")).first()


def _por_semana(t):
    s, ini, fin = _semanal(t)
    semanas = oc.calendario_semanal(t.spark, ini, fin, DESPLAZAMIENTO)
    return semanas.join(s.groupBy("ds").agg(F.sum("y").alias("y")), "ds", "left").na.fill(0.0, ["y"])


YS = "(SELECT ds, SUM(y) AS y FROM v_serie GROUP BY ds)"


@consulta("src_calendario", """
SELECT c.holiday, c.ds, COALESCE(SUM(Cantidad), 0) AS unidades
FROM v_cal c LEFT JOIN v_ventas v ON v.Fecha = c.ds GROUP BY c.holiday, c.ord, c.ds""",
          dobles="unidades")
def _(t):
    c = cal.src_calendario(t.spark, DESPLAZAMIENTO).select("holiday", "ds")
    return c.join(_ventas_dia(t), "ds", "left").na.fill(0.0, ["unidades"])


@consulta("agg_calendario", """
SELECT c.holiday, MIN(c.ds) AS desde, MAX(c.ds) AS hasta, COUNT(*) AS dias,
       SUM(u) AS unidades
FROM v_cal c LEFT JOIN (SELECT Fecha, SUM(Cantidad) AS u FROM v_ventas GROUP BY 1) v
  ON v.Fecha = c.ds GROUP BY c.holiday""", dobles="unidades")
def _(t):
    c = cal.src_calendario(t.spark, DESPLAZAMIENTO)
    u = (c.join(_ventas_dia(t), "ds").groupBy("holiday").agg(F.sum("unidades").alias("unidades")))
    return oc.agg_calendario(c).join(u, "holiday", "left")


# Easter of the years the ledger spans, as published.
PASCUAS = {1995: "04-16", 1996: "04-07", 1997: "03-30", 1998: "04-12", 1999: "04-04",
           2000: "04-23", 2001: "04-15"}


@consulta("src_festivos", """
SELECT h.holiday, h.ds, COALESCE(SUM(Cantidad), 0) AS unidades FROM (
  SELECT nombre AS holiday, make_date(a, m, d) AS ds
  FROM range(1995, 2002) y(a), (VALUES %s) f(nombre, m, d)
  UNION ALL
  SELECT nombre, make_date(a, m, d) + CAST((8 - isodow(make_date(a, m, d))) %% 7 AS INTEGER)
  FROM range(1995, 2002) y(a), (VALUES %s) f(nombre, m, d)
  UNION ALL
  SELECT nombre, p + k FROM (VALUES %s) q(p), (VALUES %s) f(nombre, k)) h
LEFT JOIN v_ventas v ON v.Fecha = h.ds GROUP BY 1, 2""" % (
    ", ".join(f"('{n}', {m}, {d})" for n, m, d in cal.FIJOS),
    ", ".join(f"('{n}', {m}, {d})" for n, m, d in cal.TRASLADADOS),
    ", ".join(f"(DATE '{a}-{x}')" for a, x in PASCUAS.items()),
    ", ".join(f"('{n}', {k})" for n, k in cal.PASCUA)), dobles="unidades")
def _(t):
    v = _ventas_dia(t)
    # Years straight off the date column of the file; no join is needed for its range.
    a, b = t.t("lineitem").agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    return cal.src_festivos(t.spark, a, b).join(v, "ds", "left").na.fill(0.0, ["unidades"])


@consulta("src_inicios", f"""
SELECT i.inicio, y FROM v_inicios i LEFT JOIN {YS} s ON s.ds = i.inicio""", dobles="y")
def _(t):
    s = t.semanal().groupBy(F.col("ds").alias("inicio")).agg(F.sum("y").alias("y"))
    return cal.src_inicios(t.spark, DESPLAZAMIENTO).join(s, "inicio", "left")


@consulta("win_semana_acad",
          f"SELECT a.ds, a.semana_academica, y FROM v_acad a JOIN {YS} s USING (ds)", dobles="y")
def _(t):
    return _por_semana(t).select("ds", "semana_academica", "y")


@consulta("jn_asof_inicio", f"SELECT a.ds, a.inicio, y FROM v_acad a JOIN {YS} s USING (ds)",
          dobles="y")
def _(t):
    return _por_semana(t).select("ds", "inicio", "y")


@consulta("jn_conteo_rango", """
SELECT inicio, MAX(semana_academica) AS semanas, SUM(y) AS y FROM (
  SELECT a.inicio, y, CASE WHEN semana_academica < 17 OR etiqueta LIKE 'cierre%' THEN
         semana_academica END AS semana_academica
  FROM v_acad a JOIN v_serie s USING (ds)) x GROUP BY inicio""", dobles="y")
def _(t):
    semana = F.when((F.col("semana_academica") < 17) | F.col("etiqueta").startswith("cierre"),
                    F.col("semana_academica"))
    return _por_semana(t).groupBy("inicio").agg(F.max(semana).alias("semanas"),
                                                F.sum("y").alias("y"))


@consulta("jn_mapa_dia", """
SELECT v.Fecha AS ds, e.etiqueta, SUM(Cantidad) AS unidades
FROM v_ventas v LEFT JOIN v_etiqueta e ON e.ds = v.Fecha GROUP BY 1, 2""", dobles="unidades")
def _(t):
    mapa = oc.jn_mapa_dia(cal.src_calendario(t.spark, DESPLAZAMIENTO))
    return _ventas_dia(t).join(F.broadcast(mapa), "ds", "left").select("ds", "etiqueta", "unidades")


@consulta("jn_rango_festivo", f"SELECT h.*, y FROM v_hol h JOIN {YS} s USING (ds)", dobles="y")
def _(t):
    return _por_semana(t).select("ds", *[f"hol_{h}" for h in cal.NOMBRES], "y")


@consulta("agg_tramos", """
SELECT holiday, MIN(ds) AS ini, MAX(ds) AS fin, COUNT(*) AS dias, SUM(u) AS unidades FROM (
  SELECT holiday, ds, u, ds - CAST(ROW_NUMBER() OVER (PARTITION BY holiday ORDER BY ds) AS INTEGER)
         AS isla
  FROM (SELECT DISTINCT holiday, ds FROM v_cal) c
  LEFT JOIN (SELECT Fecha, SUM(Cantidad) AS u FROM v_ventas GROUP BY 1) v ON v.Fecha = c.ds) x
GROUP BY holiday, isla""", dobles="unidades")
def _(t):
    dias = cal.src_calendario(t.spark, DESPLAZAMIENTO).select("holiday", "ds")
    tramos = oc.agg_tramos(dias)
    # Sales of a span: each day knows its span by its own row, so the join is on equal days.
    por_dia = tramos.select("holiday", "ini", "fin", "dias", F.explode(
        F.sequence("ini", "fin", F.expr("interval 1 day"))).alias("ds"))
    return (por_dia.join(_ventas_dia(t), "ds", "left").groupBy("holiday", "ini", "fin", "dias")
            .agg(F.sum("unidades").alias("unidades")))


@consulta("flt_solape", """
SELECT holiday, GREATEST(ini, lo) AS ini, LEAST(fin, hi) AS fin
FROM v_bloques, (SELECT MIN(Fecha) + 1000 AS lo, MAX(Fecha) - 1000 AS hi FROM v_ventas) r
WHERE ini <= hi AND fin >= lo""")
def _(t):
    lo, hi = t.t("lineitem").agg(
        F.date_add(F.min("l_shipdate").cast("date"), 1000),
        F.date_sub(F.max("l_shipdate").cast("date"), 1000)).first()
    return f.flt_solape(cal.bloques(t.spark, DESPLAZAMIENTO).drop("ord"), F.lit(lo), F.lit(hi))


@consulta("fec_calendario", f"""
SELECT ds, CAST(month(ds) AS INTEGER) AS mes, CAST(weekofyear(ds) AS INTEGER) AS semana_anio,
       CAST(quarter(ds) AS INTEGER) AS trimestre,
       CASE WHEN quarter(ds) <= 2 THEN 1 ELSE 2 END AS semestre, y FROM {YS}""", dobles="y")
def _(t):
    s = t.semanal().groupBy("ds").agg(F.sum("y").alias("y"))
    return s.withColumns(fd.fec_calendario("ds"))


@consulta("fec_ciclicas", f"""
SELECT ds, sin(2 * pi() * month(ds) / 12) AS mes_sin, cos(2 * pi() * month(ds) / 12) AS mes_cos,
       sin(2 * pi() * weekofyear(ds) / 52) AS semana_sin,
       cos(2 * pi() * weekofyear(ds) / 52) AS semana_cos, y FROM {YS}""",
          dobles="mes_sin:6 mes_cos:6 semana_sin:6 semana_cos:6 y")
def _(t):
    s = t.semanal().groupBy("ds").agg(F.sum("y").alias("y"))
    return s.withColumns(fd.fec_ciclicas("ds"))


@consulta("fec_antes_verano", f"""
SELECT ds, CAST(CASE WHEN DATE '1996-06-02' > ds
       THEN GREATEST(0, 4 - (DATE '1996-06-02' - ds) // 7) ELSE 0 END AS INTEGER)
       AS semanas_antes_verano, y FROM {YS}""", dobles="y")
def _(t):
    import datetime as dt
    s = t.semanal().groupBy("ds").agg(F.sum("y").alias("y"))
    return s.withColumn("semanas_antes_verano",
                        fd.fec_antes_verano("ds", F.lit(dt.date(1996, 6, 2))))


MARCAS = """CAST(semana_academica = 7 AS INTEGER) AS inicio_parciales_1,
       CAST(semana_academica = 8 AS INTEGER) AS fin_parciales_1,
       CAST(semana_academica = 12 AS INTEGER) AS inicio_parciales_2,
       CAST(semana_academica = 13 AS INTEGER) AS fin_parciales_2,
       CAST(semana_academica IN (1, 2) AS INTEGER) AS vuelta_a_clases"""


@consulta("fec_marcas", f"SELECT a.ds, {MARCAS}, y FROM v_acad a JOIN {YS} s USING (ds)", dobles="y")
def _(t):
    s = _por_semana(t)
    return s.select("ds", *[c.alias(n) for n, c in fd.fec_marcas("semana_academica").items()], "y")
