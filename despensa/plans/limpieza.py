"""Cleaning, projection and filter queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from despensa.functions import dates as fd
from despensa.functions import numbers as num
from despensa.functions import text as tx
from despensa.operators import filters as f
from despensa.operators import joins as j
from despensa.operators import panel as p
from despensa.plans.bindings import vista
from despensa.plans.registro import consulta
from despensa.sources import files as src


@consulta("prj_renombrar", """
SELECT o_orderkey AS Consecutivo, o_custkey AS Cliente, o_orderstatus AS Estado,
       o_totalprice AS Total, CAST(o_orderdate AS DATE) AS Fecha, o_orderpriority AS Forma_pago
FROM orders""")
def _(t):
    d = src.prj_renombrar(t.t("orders"), ["Consecutivo", "Cliente", "Estado", "Total", "Fecha",
                                          "Forma_pago"])
    return d.withColumn("Fecha", F.col("Fecha").cast("date"))


@consulta("prj_seleccion", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    return src.prj_seleccion(t.t("orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"],
                             ("o_orderstatus",))


# Dates as text in the shapes the files use, one that is no date and one no calendar should reach.
vista("v_fechas", """
SELECT o_orderkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%-m-%-d')
  WHEN '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00')
  WHEN '5-LOW' THEN '9999-12-31'
  ELSE strftime(o_orderdate, '31/02/%Y') END AS texto FROM orders""")


@consulta("cln_fecha", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
       THEN CAST(o_orderdate AS DATE) END AS Fecha,
       CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM')
       THEN CAST(o_orderdate AS DATE) END AS Iso FROM orders""")
def _(t):
    o, d = t.t("orders"), F.col("o_orderdate")
    prioridad = F.col("o_orderpriority")
    texto = (F.when(prioridad == "1-URGENT", F.date_format(d, "yyyy-M-d"))
             .when(prioridad == "2-HIGH", F.date_format(d, "dd/MM/yyyy"))
             .when(prioridad == "3-MEDIUM", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
             .when(prioridad == "5-LOW", "9999-12-31")
             .otherwise(F.concat(F.lit("31/02/"), F.date_format(d, "yyyy"))))
    return o.select("o_orderkey", fd.cln_fecha(texto, fd.DIA_PRIMERO).alias("Fecha"),
                    fd.cln_fecha(texto).alias("Iso"))


@consulta("cln_numero", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 "
                        "ELSE o_totalprice END AS Cantidad FROM orders")
def _(t):
    texto = F.when(F.col("o_orderstatus") == "P", "x").otherwise(
        F.col("o_totalprice").cast("string"))
    return t.t("orders").select("o_orderkey", num.cln_numero(texto).alias("Cantidad"))


@consulta("cln_total", """
SELECT Consecutivo, Codigo, Cantidad,
       CASE WHEN Establecimiento IS NULL THEN Cantidad * Precio ELSE Total END AS total_lote,
       CASE WHEN Establecimiento IS NULL THEN 0 ELSE Total END AS total_panel
FROM v_ventas""", dobles="Cantidad total_lote total_panel")
def _(t):
    total = F.when(F.col("Establecimiento").isNotNull(), F.col("Total")).cast("string")
    return t.ventas().select(
        "Consecutivo", "Codigo", "Cantidad",
        num.cln_total(total, "Cantidad", "Precio").alias("total_lote"),
        num.cln_total(total, "Cantidad", "Precio", "cero").alias("total_panel"))


@consulta("cln_moneda", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS Total
FROM orders""", dobles="Total:2")
def _(t):
    # 1,234.56 written the local way, $1.234,56.
    texto = F.concat(F.lit("$"), F.translate(F.format_number("o_totalprice", 2), ",.", ".,"))
    return t.t("orders").select("o_orderkey", num.cln_moneda(
        F.when(F.col("o_orderstatus") != "P", texto)).alias("Total"))


# Names as a till writes them: sizes, prices and volumes round the part's name.
ADORNO = [("ECONOMY", "", " Grande(21k)"), ("SMALL", "Veggie ", " mediano (18k)"),
          ("MEDIUM", "Agua  ", " 600ML"), ("PROMO", "9oz ", " MEDIANA")]
vista("v_nombres", "SELECT p_partkey, CASE p_type "
      + " ".join(f"WHEN '{k}' THEN '{a}' || p_name || '{b}'" for k, a, b in ADORNO)
      + " WHEN 'STANDARD' THEN '(' || p_name || ')' ELSE 'Agua cristal 250ml' END AS texto FROM part")
LIMPIO = "texto"
for _patron in tx.PATRONES:
    LIMPIO = f"regexp_replace({LIMPIO}, '{_patron}', '', 'gi')"
LIMPIO = rf"trim(regexp_replace({LIMPIO}, '{tx.BLANCO}+', ' ', 'g'))"
CANON = "CASE l " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in tx.CANONICOS.items()) + " ELSE l END"


def _nombres(t):
    tipo, texto = F.col("p_type"), None
    for k, a, b in ADORNO:
        v = F.concat(F.lit(a), "p_name", F.lit(b))
        texto = F.when(tipo == k, v) if texto is None else texto.when(tipo == k, v)
    texto = texto.when(tipo == "STANDARD", F.concat(F.lit("("), "p_name", F.lit(")")))
    return t.t("part").select("p_partkey", texto.otherwise("Agua cristal 250ml").alias("texto"))


@consulta("cln_nombre", f"""
SELECT p_partkey, CASE WHEN length(c) > 0 THEN c ELSE texto END AS nombre,
       CASE WHEN length(c) > 0 THEN upper(left(c, 1)) || lower(substring(c, 2)) ELSE texto END
         AS capitalizado
FROM (SELECT *, {CANON} AS c FROM (SELECT *, {LIMPIO} AS l FROM v_nombres) x) y""")
def _(t):
    return _nombres(t).select("p_partkey", tx.cln_nombre("texto").alias("nombre"),
                              tx.cln_nombre("texto", capitalizar=True).alias("capitalizado"))


@consulta("cln_nombre_textos", f"""
SELECT doc_id, md5(nombre) AS huella, length(nombre) AS largo FROM (
  SELECT doc_id, CASE WHEN length(l) > 0 THEN l ELSE texto END AS nombre
  FROM (SELECT doc_id, text AS texto, {LIMPIO} AS l FROM (SELECT doc_id, text, text AS texto
        FROM documents) d) x) y""")
def _(t):
    n = tx.cln_nombre("text")
    return t.t("documents").select("doc_id", F.md5(n).alias("huella"),
                                   F.length(n).cast("bigint").alias("largo"))


@consulta("cln_acentos", rf"""
SELECT doc_id, md5(s) AS huella, length(s) AS largo FROM (
  SELECT doc_id, COALESCE(trim(regexp_replace(strip_accents(lower(text)), '{tx.BLANCO}+', ' ', 'g')),
                          '') AS s FROM documents) x""")
def _(t):
    n = tx.cln_acentos("text")
    return t.t("documents").select("doc_id", F.md5(n).alias("huella"),
                                   F.length(n).cast("bigint").alias("largo"))


vista("v_venta_nombre", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Sándwich ' || p_name || ' Mediano (18k)'
  WHEN 'SMALL' THEN 'Bowl ' || p_name || ' mediana' WHEN 'MEDIUM' THEN 'Ensalada  ' || p_name
  WHEN 'PROMO' THEN p_name || ' veggie  grande' ELSE 'Bowl Smoothie ' || p_name END AS texto
FROM part""")
VENTA = r"""trim(regexp_replace(trim(regexp_replace(
  trim(regexp_replace(strip_accents(lower(texto)), '\s+', ' ', 'g')), '\([^\n]*?\)', '', 'g')),
  '^(?:sandwich |bowl |ensalada |smoothie |pancakes )', ''))"""
vista("v_limpia", f"SELECT p_partkey, {VENTA} AS limpio FROM v_venta_nombre", "v_venta_nombre")


def _venta(t):
    tipo, n = F.col("p_type"), F.col("p_name")
    return t.t("part").select("p_partkey", (
        F.when(tipo == "ECONOMY", F.concat(F.lit("Sándwich "), n, F.lit(" Mediano (18k)")))
        .when(tipo == "SMALL", F.concat(F.lit("Bowl "), n, F.lit(" mediana")))
        .when(tipo == "MEDIUM", F.concat(F.lit("Ensalada  "), n))
        .when(tipo == "PROMO", F.concat(n, F.lit(" veggie  grande")))
        .otherwise(F.concat(F.lit("Bowl Smoothie "), n))).alias("texto"))


@consulta("cln_venta", "SELECT * FROM v_limpia")
def _(t):
    return _venta(t).select("p_partkey", tx.cln_venta("texto").alias("limpio"))


_cand = " UNION ALL ".join(
    ["SELECT p_partkey, 0 AS k, limpio AS v FROM v_limpia"]
    + [f"SELECT p_partkey, {i + 1}, trim(left(limpio, length(limpio) - {len(x)})) FROM v_limpia "
       f"WHERE ends_with(limpio, '{x}')" for i, x in enumerate(tx.SUFIJOS)]
    + [f"SELECT p_partkey, {8 + i}, replace(limpio, '{a}', '{b}') FROM v_limpia "
       f"WHERE contains(limpio, '{a}')"
       for i, (a, b) in enumerate([("mediano", "mediana"), ("mediana", "mediano")])])
vista("v_variantes", f"""
SELECT p_partkey, v AS variante,
       CAST(ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY MIN(k)) - 1 AS INTEGER) AS pos
FROM ({_cand}) c GROUP BY p_partkey, v""", "v_limpia")


@consulta("cln_variantes", "SELECT * FROM v_variantes")
def _(t):
    return _venta(t).select("p_partkey", F.posexplode(
        tx.cln_variantes(tx.cln_venta("texto"))).alias("pos", "variante"))


set_distinto_sql = "SELECT p_partkey, COUNT(*) AS variantes, string_agg(variante, '|' ORDER BY pos) " \
                   "AS todas FROM v_variantes GROUP BY p_partkey"


@consulta("set_distinto", set_distinto_sql)
def _(t):
    v = tx.cln_variantes(tx.cln_venta("texto"))
    return _venta(t).select("p_partkey", F.size(v).cast("bigint").alias("variantes"),
                            F.array_join(v, "|").alias("todas"))


@consulta("cat_local", """
SELECT Num_comp, CASE Num_comp WHEN 'FV-1' THEN 'Principal' WHEN 'FV-2' THEN 'Eventos'
       WHEN 'FV-3' THEN 'Eventos' WHEN 'FV-4' THEN 'CP' END AS Lugar, COUNT(*) AS lineas,
       SUM(Total) AS Total FROM v_ventas GROUP BY 1, 2""", dobles="Total")
def _(t):
    return t.ventas().groupBy("Num_comp", tx.cat_local("Num_comp").alias("Lugar")).agg(
        F.count(F.lit(1)).alias("lineas"), F.sum("Total").alias("Total"))


@consulta("num_recorte", """
SELECT producto, ds, CAST(ceil(GREATEST(prophet - 100, 0)) AS BIGINT) AS unidades
FROM v_historial""")
def _(t):
    return t.historial().select("producto", "ds",
                                num.num_recorte(F.col("prophet") - 100).alias("unidades"))


@consulta("num_redondeo", """
SELECT producto, ds, round_even(y / 2, 0) AS r0, round_even(y / 4, 1) AS r1,
       round_even(y / 8, 2) AS r2, CAST(format('{:.1f}', y / 20) AS DOUBLE) AS r3,
       CAST(format('{:.2f}', (y + 335) / 200) AS DOUBLE) AS r4 FROM v_semanal""")
def _(t):
    y = F.col("y")
    return t.semanal().select("producto", "ds", num.num_redondeo(y / 2, 0).alias("r0"),
                              num.num_redondeo(y / 4, 1).alias("r1"),
                              num.num_redondeo(y / 8, 2).alias("r2"),
                              num.num_redondeo(y / 20, 1).alias("r3"),
                              num.num_redondeo((y + 335) / 200, 2).alias("r4"))


# ---- filters ----


@consulta("flt_tipo", "SELECT * FROM v_costos_crudos WHERE Tipo = 'Compra/Gasto'")
def _(t):
    return f.flt_tipo(t.costos_crudos(), "Compra/Gasto", "Tipo")


@consulta("flt_local_fecha", """
SELECT Consecutivo, Fecha, Nombre, Cantidad, Total FROM v_ventas
WHERE Establecimiento = 'Principal' AND Fecha >= DATE '1996-01-01'""", dobles="Cantidad Total")
def _(t):
    return f.flt_local_fecha(t.ventas(), "Principal", "1996-01-01").select(
        "Consecutivo", "Fecha", "Nombre", "Cantidad", "Total")


@consulta("flt_rango", """
SELECT Consecutivo, Fecha, Nombre, Total FROM v_ventas
WHERE strftime(Fecha, '%Y-%m') BETWEEN '1997-03' AND '1999-08' AND Establecimiento = 'CP'""",
          dobles="Total")
def _(t):
    return f.flt_rango(t.ventas(), "1997-03", "1999-08", "CP").select(
        "Consecutivo", "Fecha", "Nombre", "Total")


@consulta("flt_costos", "SELECT * FROM v_costos")
def _(t):
    return t.costos()


@consulta("flt_nulos", "SELECT Consecutivo, Fecha, Establecimiento FROM v_ventas "
                       "WHERE Establecimiento IS NOT NULL AND Fecha IS NOT NULL")
def _(t):
    return f.flt_nulos(t.ventas(), "Establecimiento", "Fecha").select(
        "Consecutivo", "Fecha", "Establecimiento")


@consulta("flt_recientes", """
SELECT Consecutivo, Fecha, Nombre FROM v_ventas
WHERE Fecha >= (SELECT MAX(Fecha) FROM v_ventas) - 90""")
def _(t):
    return f.flt_recientes(t.ventas()).select("Consecutivo", "Fecha", "Nombre")


@consulta("flt_ventana", """
SELECT event_id, CAST(ts AS DATE) AS Fecha FROM events
WHERE CAST(ts AS DATE) BETWEEN (SELECT MAX(CAST(ts AS DATE)) FROM events) - 7
  AND (SELECT MAX(CAST(ts AS DATE)) FROM events)""")
def _(t):
    e = t.t("events").select("event_id", F.col("ts").cast("date").alias("Fecha"))
    return f.flt_ventana(e, e.select(F.max("Fecha")).scalar())


@consulta("flt_encabezado", "SELECT p_partkey, p_name AS receta FROM part WHERE p_type <> 'PROMO'")
def _(t):
    receta = F.when(F.col("p_type") == "PROMO", " Receta ").otherwise(F.col("p_name"))
    return f.flt_encabezado(t.t("part").select("p_partkey", receta.alias("receta")))


# ---- joins, sets and order on the ledger ----


@consulta("jn_catalogo", """
SELECT Consecutivo, Nombre, COALESCE(Categoria, 'Sin categoria') AS Categoria, Total
FROM v_ventas LEFT JOIN (
  SELECT Nombre, CASE WHEN plata_generada >= (SELECT AVG(plata_generada) FROM v_producto)
                      THEN 'alto' END AS Categoria FROM v_producto) c USING (Nombre)""",
          dobles="Total")
def _(t):
    from despensa.operators.segment import agg_producto
    from despensa.soporte import cortar
    info = cortar(agg_producto(t.ventas()))
    media = info.select(F.avg("plata_generada")).scalar()
    catalogo = info.filter(F.col("plata_generada") >= media).select(
        "Nombre", F.lit("alto").alias("Categoria"))
    return j.jn_catalogo(t.ventas(), catalogo).select("Consecutivo", "Nombre", "Categoria", "Total")


@consulta("set_union", """
SELECT Fecha, Total FROM v_ventas
UNION ALL SELECT Fecha, Valor FROM v_costos""", dobles="Total")
def _(t):
    return j.set_union(
        t.ventas().select("Fecha", "Total"),
        t.costos().select("Fecha", F.col("Valor").alias("Total")))


@consulta("set_union_tag", """
SELECT Lugar, strftime(Fecha, '%Y-%m') AS Mes, SUM(Total) AS Total FROM (
  SELECT 'CP' AS Lugar, Fecha, Total FROM v_ventas WHERE Establecimiento = 'CP'
  UNION ALL SELECT 'Principal', Fecha, Total FROM v_ventas WHERE Establecimiento = 'Principal'
  UNION ALL SELECT 'otro', Fecha, Total FROM v_ventas
  WHERE coalesce(Establecimiento, '') NOT IN ('CP', 'Principal')) x
GROUP BY 1, 2""", dobles="Total")
def _(t):
    v = t.ventas()
    local = F.coalesce("Establecimiento", F.lit(""))
    partes = {l: v.filter(local == l).select("Fecha", "Total") for l in ("CP", "Principal")}
    partes["otro"] = v.filter(~local.isin("CP", "Principal")).select("Fecha", "Total")
    return j.set_union_tag(partes).groupBy("Lugar", p.periodo("Fecha", "Mes").alias("Mes")).agg(
        F.sum("Total").alias("Total"))


@consulta("agg_distintos", """
SELECT 'mes' AS lista, strftime(Fecha, '%Y-%m') AS valor FROM v_ventas GROUP BY 2
UNION ALL SELECT 'local', Establecimiento FROM v_ventas WHERE Establecimiento IS NOT NULL GROUP BY 2
UNION ALL SELECT 'producto', Nombre FROM v_ventas GROUP BY 2""")
def _(t):
    v = t.ventas()
    listas = {"mes": p.periodo("Fecha", "Mes"), "local": "Establecimiento", "producto": "Nombre"}
    return j.set_union(*[
        p.agg_distintos(v, c, "valor").select(F.lit(n).alias("lista"), "valor")
        for n, c in listas.items()])


@consulta("ord_orden", "SELECT Fecha, Consecutivo, Total FROM v_ventas ORDER BY Fecha, Consecutivo",
          dobles="Total")
def _(t):
    return t.ventas().select("Fecha", "Consecutivo", "Total").orderBy("Fecha", "Consecutivo")


@consulta("ord_topk", "SELECT Consecutivo, SUM(Total) AS Total FROM v_ventas GROUP BY 1 "
                      "ORDER BY SUM(Total) DESC, Consecutivo LIMIT 10", dobles="Total")
def _(t):
    return (t.ventas().groupBy("Consecutivo").agg(F.sum("Total").alias("Total"))
            .orderBy(F.col("Total").desc(), "Consecutivo").limit(10))


vista("v_dif", """
SELECT 'Fecha' AS columna, 'ambas' AS lado UNION ALL
SELECT unnest(['Proveedor', 'Tipo', 'Valor']), 'derecha' UNION ALL
SELECT unnest(['Consecutivo', 'Tipo_reg', 'Tipo_clas', 'Codigo', 'Nombre', 'Vendedor', 'Cantidad',
  'Precio', 'Impuesto', 'Total', 'Forma_pago', 'Num_comp', 'Establecimiento']), 'izquierda'""")


@consulta("esq_diferencia", """
SELECT d.columna, d.lado, CASE WHEN lado <> 'derecha' THEN v.n END AS filas_izquierda,
       CASE WHEN lado <> 'izquierda' THEN c.n END AS filas_derecha
FROM v_dif d, (SELECT COUNT(*) AS n FROM v_ventas) v, (SELECT COUNT(*) AS n FROM v_costos_crudos) c""")
def _(t):
    v, c = t.ventas(pago=True), t.costos_crudos()
    d = t.spark.createDataFrame(src.esq_diferencia(v, c), "columna string, lado string")
    nv, nc = (x.select(F.count(F.lit(1))).scalar() for x in (v, c))
    return d.withColumns({
        "filas_izquierda": F.when(F.col("lado") != "derecha", nv),
        "filas_derecha": F.when(F.col("lado") != "izquierda", nc)})


@consulta("win_bfill", """
SELECT event_id, CAST(ts AS DATE) AS archivo,
       FIRST_VALUE(CASE WHEN event_type IN ('view', 'purchase') AND value > 50 THEN event_type END
                   IGNORE NULLS)
         OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS Forma_pago
FROM events""")
def _(t):
    from despensa.operators.ordered import win_bfill
    tipo = F.col("event_type")
    e = t.t("events").select(
        "event_id", F.col("ts").cast("date").alias("archivo"),
        F.when(tipo.isin("view", "purchase") & (F.col("value") > 50), tipo).alias("Forma_pago"))
    return win_bfill(e, "Forma_pago", ["archivo"], "event_id", F.floor(F.col("event_id") / 64))


@consulta("win_ffill", """
SELECT event_id, LAST_VALUE(CASE WHEN event_type = 'signup' THEN user_id END IGNORE NULLS)
         OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ultimo
FROM events""")
def _(t):
    from despensa.operators.ordered import win_ffill
    e = t.t("events").select("event_id", "event_type", "user_id",
                             F.col("ts").cast("date").alias("archivo"))
    alta = F.when(F.col("event_type") == "signup", F.col("user_id"))
    return win_ffill(e, alta, "ultimo", ["archivo"], "event_id",
                     F.floor(F.col("event_id") / 64)).select("event_id", "ultimo")
