"""Segmentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from despensa.operators import segment as s
from despensa.operators.filters import flt_local_fecha
from despensa.plans.bindings import vista
from despensa.plans.registro import consulta
from despensa.soporte import cortar

DESDE = "1996-01-01"  # 2024-01-01 moved to the test tables' years

vista("v_info", """
SELECT Nombre, COUNT(Cantidad) AS transacciones, SUM(Cantidad) AS cantidad_total,
       SUM(Total) AS plata_generada, SUM(Total) / SUM(Cantidad) AS precio_promedio
FROM v_ventas WHERE Establecimiento = 'Principal' AND Fecha >= DATE '1996-01-01'
GROUP BY Nombre""", "v_ventas")
vista("v_bcg", """
SELECT *, CASE
  WHEN cantidad_total >= (SELECT MEDIAN(cantidad_total) FROM v_info)
   AND plata_generada >= (SELECT MEDIAN(plata_generada) FROM v_info)
  THEN 'ESTRELLA (Alto Vol / Alto $)'
  WHEN plata_generada >= (SELECT MEDIAN(plata_generada) FROM v_info)
  THEN 'PREMIUM (Bajo Vol / Alto $)'
  WHEN cantidad_total >= (SELECT MEDIAN(cantidad_total) FROM v_info)
  THEN 'GANCHO (Alto Vol / Bajo $)'
  ELSE 'BAJO DESEMPEÑO' END AS Categoria_Matriz
FROM v_info""", "v_info")
vista("v_estrella",
      "SELECT * FROM v_bcg WHERE Categoria_Matriz = 'ESTRELLA (Alto Vol / Alto $)'", "v_bcg")


def _pareto(tabla: str, metrica: str) -> str:
    return f"""
SELECT *, {metrica} / SUM({metrica}) OVER () AS pct,
       SUM({metrica}) OVER (ORDER BY {metrica} DESC, md5(Nombre), Nombre
                            ROWS UNBOUNDED PRECEDING) / SUM({metrica}) OVER () AS pct_acum,
       ROW_NUMBER() OVER (ORDER BY {metrica} DESC, md5(Nombre), Nombre) AS rango
FROM {tabla}"""


vista("v_par_plata", _pareto("v_estrella", "plata_generada"), "v_estrella")
vista("v_par_trans", _pareto("v_estrella", "transacciones"), "v_estrella")
vista("v_par_todo", _pareto("v_info", "plata_generada"), "v_info")

INFO = "cantidad_total plata_generada precio_promedio:6"


def _info(t):
    return cortar(s.agg_producto(flt_local_fecha(t.ventas(), "Principal", DESDE)))


def _estrella(t):
    return s.agg_bcg(_info(t)).filter(F.col("Categoria_Matriz") == s.ESTRELLA)


@consulta("agg_producto", "SELECT * FROM v_producto",
          dobles="cantidad_total plata_generada precio_promedio:6")
def _(t):
    return s.agg_producto(t.ventas())


@consulta("agg_bcg", "SELECT Nombre, Categoria_Matriz, cantidad_total, plata_generada FROM v_bcg",
          dobles="cantidad_total plata_generada")
def _(t):
    return s.agg_bcg(_info(t)).select("Nombre", "Categoria_Matriz", "cantidad_total",
                                      "plata_generada")


@consulta("agg_bcg_conteo",
          "SELECT Categoria_Matriz, COUNT(*) AS productos FROM v_bcg GROUP BY Categoria_Matriz")
def _(t):
    return s.agg_bcg(_info(t)).groupBy("Categoria_Matriz").agg(
        F.count(F.lit(1)).alias("productos"))


@consulta("win_pareto", "SELECT * FROM v_par_todo", dobles=INFO + " pct:6 pct_acum:6")
def _(t):
    return s.win_pareto(_info(t), "plata_generada")


@consulta("win_abc", """
SELECT Nombre, rango,
  CASE WHEN pct_acum - pct < 0.80 THEN 'A' WHEN pct_acum - pct < 0.95 THEN 'B' ELSE 'C' END
    AS clase_cruce,
  CASE WHEN pct_acum <= 0.80 THEN 'A' WHEN pct_acum <= 0.95 THEN 'B' ELSE 'C' END
    AS clase_exclusiva
FROM v_par_plata""")
def _(t):
    p = s.win_pareto(_estrella(t), "plata_generada")
    p = s.win_abc(p, clase="clase_cruce", regla="cruce")
    return s.win_abc(p, clase="clase_exclusiva", regla="exclusiva").select(
        "Nombre", "rango", "clase_cruce", "clase_exclusiva")


@consulta("win_abc_transacciones", """
SELECT Nombre, transacciones, rango, pct, pct_acum,
  CASE WHEN pct_acum - pct < 0.80 THEN 'A' WHEN pct_acum - pct < 0.95 THEN 'B' ELSE 'C' END
    AS Clase_ABC
FROM v_par_trans""", dobles="pct:6 pct_acum:6")
def _(t):
    return s.win_abc(s.win_pareto(_estrella(t), "transacciones")).select(
        "Nombre", "transacciones", "rango", "pct", "pct_acum", "Clase_ABC")


@consulta("win_n80",
          "SELECT COUNT(*) FILTER (WHERE pct_acum <= 0.80) + 1 AS n80 FROM v_par_todo")
def _(t):
    return s.win_n80(s.win_pareto(_info(t), "plata_generada"))


@consulta("win_rank", "SELECT Nombre, plata_generada, rango FROM v_par_todo",
          dobles="plata_generada")
def _(t):
    return s.win_pareto(_info(t), "plata_generada").select("Nombre", "plata_generada", "rango")


CRITICOS = """
SELECT p.* EXCLUDE (rango) FROM v_par_plata p
WHERE p.pct_acum - p.pct < 0.80
  AND Nombre IN (SELECT Nombre FROM v_par_trans WHERE pct_acum - pct < 0.80)"""
vista("v_criticos", CRITICOS, "v_par_plata", "v_par_trans")


@consulta("set_interseccion", "SELECT * FROM v_criticos", dobles=INFO + " pct:6 pct_acum:6")
def _(t):
    return s.productos_criticos(t.ventas(), "Principal", DESDE)


@consulta("jn_semi", """
SELECT Nombre, Fecha, SUM(Cantidad) AS Cantidad, SUM(Total) AS Total
FROM v_ventas WHERE Nombre IN (SELECT Nombre FROM v_criticos) GROUP BY Nombre, Fecha""",
          dobles="Cantidad Total")
def _(t):
    v = t.ventas()
    criticos = s.productos_criticos(v, "Principal", DESDE).select("Nombre")
    return (v.join(criticos, "Nombre", "left_semi").groupBy("Nombre", "Fecha")
            .agg(F.sum("Cantidad").alias("Cantidad"), F.sum("Total").alias("Total")))
