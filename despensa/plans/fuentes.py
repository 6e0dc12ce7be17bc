"""File sources, recipes, sinks and ingest. Each query writes files derived from the given tables
below the shared folder and reads them back through the source under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from despensa import esquemas
from despensa.operators import joins as j
from despensa.operators import panel as p
from despensa.operators import recipes as r
from despensa.operators.ordered import win_bfill
from despensa.plans import panel  # noqa: F401  (declares v_precios)
from despensa.plans.bindings import vista
from despensa.plans.registro import consulta
from despensa.sinks import marts as snk
from despensa.soporte import ruta_nueva
from despensa.sources import files as src
from despensa.sources import invoices as inv
from despensa.sources import marts as sm
from despensa.streaming import ingest

CSV = {"header": True, "quote": '"', "escape": '"', "quoteAll": True}


def _texto(df):
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


# A ledger with the faults files have: dates that do not exist, letters for numbers, missing totals.
@consulta("src_ventas", """
SELECT Consecutivo, Fecha, Nombre, Cantidad, Precio, Total FROM (
  SELECT Consecutivo, Fecha, Nombre, Num_comp, Precio,
         CASE Num_comp WHEN 'FV-4' THEN 0 ELSE Cantidad END AS Cantidad,
         CASE Num_comp WHEN 'FV-1' THEN Cantidad * Precio WHEN 'FV-4' THEN Total END AS Total
  FROM v_ventas WHERE Num_comp <> 'FV-9') x""", dobles="Cantidad Precio:8 Total")
def _(t):
    v = t.ventas()
    n = F.col("Num_comp")
    malo = _texto(v).withColumns({
        "Fecha": F.when(n == "FV-9", "31/02/2024").otherwise(F.col("Fecha")),
        "Cantidad": F.when(n == "FV-4", "x").otherwise(F.col("Cantidad")),
        "Total": F.when(n != "FV-1", F.col("Total")),
    })
    ruta = ruta_nueva(t.spark, "ventas")
    malo.write.options(**CSV).csv(ruta)
    return src.src_ventas(t.spark, ruta).select(
        "Consecutivo", "Fecha", "Nombre", "Cantidad", "Precio", "Total")


@consulta("src_catalogo", """
SELECT CASE WHEN transacciones > 900 THEN Nombre || chr(10) || '"x"' ELSE Nombre END AS Nombre,
       CAST(transacciones AS DOUBLE) AS Trans, cantidad_total AS Cant_total,
       plata_generada AS Ingresos_total, 'B' AS Categoria FROM v_producto""",
          dobles="Cant_total Ingresos_total")
def _(t):
    from despensa.operators.segment import agg_producto
    i = agg_producto(t.ventas()).select(
        F.when(F.col("transacciones") > 900, F.concat("Nombre", F.lit('\n"x"')))
        .otherwise(F.col("Nombre")).alias("Nombre"),
        "transacciones", "cantidad_total", "precio_promedio", "plata_generada",
        F.lit("B").alias("Categoria_Matriz"))
    ruta = ruta_nueva(t.spark, "catalogo")
    _texto(i).write.options(**CSV).csv(ruta)
    return src.src_catalogo(t.spark, ruta).drop("Precio_prom")


COMPRAS_SQL = """
SELECT CAST(o_orderdate AS DATE) AS Fecha, 'Compra/Gasto' AS Tipo,
       CAST(o_custkey AS VARCHAR) AS Proveedor, o_totalprice AS Valor
FROM orders WHERE o_orderstatus <> 'P'"""


def _compras(t):
    o = t.t("orders")
    valores = {"Consecutivo": F.col("o_orderkey"), "Proveedor": F.col("o_custkey"),
               "Fecha": F.date_format("o_orderdate", "yyyy-MM-dd"), "Total": F.col("o_totalprice"),
               "Tipo_reg": F.when(F.col("o_orderstatus") == "P", "Impuesto").otherwise("Secuencia")}
    d = o.select([valores.get(c, F.lit("")).cast("string").alias(c) for c in esquemas.COMPRAS])
    ruta = ruta_nueva(t.spark, "compras")
    d.write.options(**CSV).csv(ruta)
    return ruta


@consulta("src_compras_csv", COMPRAS_SQL)
def _(t):
    return src.src_compras_csv(t.spark, _compras(t))


def _informe(df, n: int, por: dict, ruta: str, particion: str | None = None):
    """Writes a report by position, a preamble line per file row group included as rows."""
    cols = [por.get(i, F.lit("Informe")).cast("string").alias(f"c{i}") for i in range(n)]
    extra = [F.col(particion)] if particion else []
    w = df.select(*cols, *extra).write.option("quoteAll", True)
    (w.partitionBy(particion) if particion else w).csv(ruta)


def _compras_rep(t):
    fecha = F.when(F.col("Proveedor") != "MACHINERY", F.date_format("Fecha", "dd/MM/yyyy")) \
        .otherwise("Fecha")  # these rows look like the lines above the table
    ruta = ruta_nueva(t.spark, "compras-rep")
    _informe(t.costos_crudos(), 9, {0: F.col("Tipo"), 3: fecha, 6: F.col("Proveedor"),
                                    8: F.col("Valor")}, ruta)
    return ruta


@consulta("src_compras_rep", "SELECT * FROM v_costos WHERE Proveedor <> 'MACHINERY'")
def _(t):
    return src.src_compras_rep(t.spark, _compras_rep(t))


@consulta("cargar_costos", f"""
SELECT *, strftime(Fecha, '%Y-%m') AS Mes, strftime(date_trunc('week', Fecha), '%Y-%m-%d') AS Semana,
       strftime(Fecha, '%Y-%m-%d') AS Dia
FROM (SELECT Fecha, Tipo, Proveedor, Valor FROM v_costos WHERE Proveedor <> 'MACHINERY'
      UNION ALL SELECT Fecha, Tipo, Proveedor, Valor FROM ({COMPRAS_SQL}) c) x""")
def _(t):
    return src.cargar_costos(t.spark, _compras_rep(t), _compras(t))


@consulta("src_facturas", """
SELECT Fecha, Tipo AS "Local", strftime(Fecha, '%Y-%m') AS Mes, COUNT(*) AS n, SUM(Valor) AS Total
FROM v_costos_crudos GROUP BY 1, 2""", dobles="Total:2")
def _(t):
    d = t.costos_crudos().withColumn("Local", F.col("Tipo"))
    total = F.concat(F.lit("$"), F.translate(F.format_number("Valor", 2), ",.", ".,"))
    ruta = ruta_nueva(t.spark, "facturas")
    _informe(d, 14, {1: F.date_format("Fecha", "dd/MM/yyyy"), 13: total}, ruta, "Local")
    return src.src_facturas(t.spark, ruta).groupBy("Fecha", "Local", "Mes").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Total").alias("Total"))


# One report per year, one row per invoice; the payment method stands on some rows only and belongs
# to the rows above it.
vista("v_reporte", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS archivo, CAST(o_orderdate AS DATE) AS Fecha,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS Forma_pago FROM orders""")


def _reportes(t):
    o = t.t("orders")
    por = {0: F.col("o_orderkey"), 1: F.date_format("o_orderdate", "dd/MM/yyyy"),
           4: F.lit("A"), 11: F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")),
           13: F.lit("Factura de venta")}
    cols = [por.get(i, F.lit("")).cast("string").alias(src.REPORTE[i]) for i in range(14)]
    d = o.select(*cols, F.year("o_orderdate").alias("archivo"), F.col("o_orderkey").alias("k"))
    ruta = ruta_nueva(t.spark, "reportes")
    # Written in invoice order, a few sorted files for each year.
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    (d.repartitionByRange(n, "archivo", "k").sortWithinPartitions("archivo", "k").drop("k")
     .write.option("quoteAll", True).partitionBy("archivo").csv(ruta))
    return src.src_reportes_mes(t.spark, ruta)


@consulta("src_reportes_mes", "SELECT archivo, Fecha, COUNT(*) AS n, COUNT(Forma_pago) AS con_pago "
                              "FROM v_reporte GROUP BY 1, 2")
def _(t):
    return _reportes(t).groupBy("archivo", "Fecha").agg(
        F.count(F.lit(1)).alias("n"), F.count("Forma_pago").alias("con_pago"))


def _libros(t):
    """Reports of invoices and purchases: an item row, then the row with its payment method."""
    o = t.t("orders")
    compra = F.col("o_orderstatus") == "O"
    dia = F.date_format("o_orderdate", "dd/MM/yyyy")
    comunes = {"Consecutivo": F.col("o_orderkey"), "Fecha": dia, "Tipo_reg": F.lit("Secuencia"),
               "Cantidad": F.lit(2), "Precio": F.col("o_totalprice") / 2, "Total": F.col("o_totalprice"),
               "Num_comp": F.when(F.col("o_orderstatus") == "F", "FV-1").otherwise("FV-4"),
               "Tipo_transaccion": F.when(compra, src.COMPRA).otherwise(src.VENTA),
               "Factura": F.col("o_clerk") if "o_clerk" in o.columns else F.lit("F"),
               "ID": F.col("o_custkey"), "Proveedor": F.concat(F.lit("P"), F.col("o_custkey")),
               **{c: dia for c in src.FECHAS_COMPRAS}}
    filas = []
    for k, suyos in enumerate(({"Codigo": F.lit("A")}, {"Forma_pago": F.col("o_orderpriority")})):
        valores = {**comunes, **suyos}
        filas.append(o.select(
            *[valores.get(c, F.lit("")).cast("string").alias(c) for c in src.REPORTE + src.REPORTE_COMPRAS],
            F.year("o_orderdate").alias("archivo"), F.col("o_orderkey").alias("k"), F.lit(k).alias("j")))
    ruta = ruta_nueva(t.spark, "libros")
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    # An invoice's rows stay together: files are cut between invoices.
    (j.set_union(*filas).repartitionByRange(n, "archivo", "k").sortWithinPartitions("archivo", "k", "j")
     .drop("k", "j").write.option("quoteAll", True).partitionBy("archivo").csv(ruta))
    return ruta


@consulta("libro_ventas", """
SELECT CAST(o_orderkey AS VARCHAR) AS Consecutivo, CAST(o_orderdate AS DATE) AS Fecha,
       o_orderpriority AS Forma_pago, o_totalprice AS Total,
       CASE o_orderstatus WHEN 'F' THEN 'Principal' ELSE 'CP' END AS Establecimiento
FROM orders WHERE o_orderstatus <> 'O'""")
def _(t):
    return src.libro_reportes(t.spark, _libros(t)).select(
        "Consecutivo", "Fecha", "Forma_pago", "Total", "Establecimiento")


@consulta("libro_compras", """
SELECT CAST(o_orderkey AS VARCHAR) AS Consecutivo, CAST(o_orderdate AS DATE) AS Fecha,
       CAST(o_orderdate AS DATE) AS Fecha_m, CAST(o_orderdate AS DATE) AS Fecha_v,
       CAST(o_custkey AS VARCHAR) AS ID, 'P' || o_custkey AS Proveedor, o_orderpriority AS Forma_pago,
       o_totalprice AS Total
FROM orders WHERE o_orderstatus = 'O'""")
def _(t):
    return src.libro_reportes(t.spark, _libros(t), src.COMPRA).select(
        "Consecutivo", "Fecha", "Fecha_m", "Fecha_v", "ID", "Proveedor", "Forma_pago", "Total")


@consulta("agg_auditoria", "SELECT archivo, MIN(Fecha) AS desde, MAX(Fecha) AS hasta "
                           "FROM v_reporte GROUP BY 1")
def _(t):
    return p.agg_auditoria(_reportes(t))


@consulta("win_bfill_reporte")
def _(t):
    # Filled inside each landed file, by its blocks; rows-only, since file cuts are the writer's.
    d = win_bfill(_reportes(t), "Forma_pago", ["bloque"], "fila", F.col("inicio"))
    return d.select("archivo", "Consecutivo", "Forma_pago")


# ---- recipes ----


@consulta("src_recetas", """
SELECT categoria, plato, ingrediente, cantidad, unidad,
       CASE WHEN plato LIKE 'hot%' THEN NULL
            ELSE FIRST_VALUE(porcion) OVER (PARTITION BY categoria, plato ORDER BY orden) END
         AS porcion
FROM v_recetas""")
def _(t):
    from pyspark.sql import Window
    orden = Window.partitionBy("categoria", "plato").orderBy("orden")
    primera = F.row_number().over(orden) == 1
    d = t.recetas().withColumn("primera", primera)
    # Row numbers that keep a dish's rows together: the dish, then the part.
    plato = F.dense_rank().over(Window.partitionBy("categoria").orderBy("plato"))
    hoja = d.select(
        (plato * F.lit(10**12) + F.col("orden")).alias("fila"),
        F.when(F.col("primera") & ~F.col("plato").startswith("hot"), F.col("porcion"))
        .alias("porcion"),
        F.when(F.col("primera"), F.col("plato")).alias("receta"), "ingrediente", "cantidad",
        "unidad", F.col("categoria").alias("hoja"))
    ruta = ruta_nueva(t.spark, "recetas")
    hoja.write.option("quoteAll", False).partitionBy("hoja").csv(ruta)
    return src.src_recetas(t.spark, ruta).drop("orden")


vista("v_venta_corta", """
SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN 'Sándwich ' || p_name || ' Mediano (18k)'
  WHEN 'SMALL' THEN 'Bowl ' || p_name || ' mediana' WHEN 'MEDIUM' THEN split_part(p_name, ' ', 2)
  WHEN 'PROMO' THEN p_name || ' veggie  grande' ELSE 'menu ' || p_brand END AS producto
FROM part""")
VAR = """
SELECT producto, v, k FROM (
  SELECT producto, v, MIN(k) AS k FROM (
    SELECT producto, 0 AS k, l AS v FROM v_corta_limpia {sufijos}) c GROUP BY 1, 2) d"""
vista("v_corta_limpia", r"""
SELECT producto, trim(regexp_replace(trim(regexp_replace(
  trim(regexp_replace(strip_accents(lower(producto)), '\s+', ' ', 'g')), '\([^\n]*?\)', '', 'g')),
  '^(?:sandwich |bowl |ensalada |smoothie |pancakes )', '')) AS l FROM v_venta_corta""",
      "v_venta_corta")
from despensa.functions.text import SUFIJOS  # noqa: E402

_suf = " ".join(
    f"UNION ALL SELECT producto, {i + 1}, trim(left(l, length(l) - {len(x)})) FROM v_corta_limpia "
    f"WHERE ends_with(l, '{x}')" for i, x in enumerate(SUFIJOS)) + " " + " ".join(
    f"UNION ALL SELECT producto, {8 + i}, replace(l, '{a}', '{b}') FROM v_corta_limpia "
    f"WHERE contains(l, '{a}')"
    for i, (a, b) in enumerate([("mediano", "mediana"), ("mediana", "mediano")]))
vista("v_corta_var", VAR.format(sufijos=_suf), "v_corta_limpia")
vista("v_mapa", """
SELECT n.producto, m.plato FROM v_venta_corta n LEFT JOIN (
  SELECT producto, plato, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY etapa, k, o) AS rn
  FROM (SELECT v.producto, d.plato, v.k, d.o, CASE WHEN v.v = d.plato THEN 1 ELSE 2 END AS etapa
        FROM v_corta_var v JOIN (SELECT plato, MIN(orden) AS o FROM v_recetas GROUP BY 1) d
          ON length(v.v) > 0 AND (contains(d.plato, v.v) OR contains(v.v, d.plato))) x) m
  ON m.producto = n.producto AND m.rn = 1""", "v_venta_corta", "v_corta_var", "v_recetas")


def _nombres_venta(t):
    tipo, n = F.col("p_type"), F.col("p_name")
    return t.t("part").select((
        F.when(tipo == "ECONOMY", F.concat(F.lit("Sándwich "), n, F.lit(" Mediano (18k)")))
        .when(tipo == "SMALL", F.concat(F.lit("Bowl "), n, F.lit(" mediana")))
        .when(tipo == "MEDIUM", F.split_part(n, F.lit(" "), F.lit(2)))
        .when(tipo == "PROMO", F.concat(n, F.lit(" veggie  grande")))
        .otherwise(F.concat(F.lit("menu "), "p_brand"))).alias("producto")).distinct()


@consulta("jn_receta", "SELECT * FROM v_mapa")
def _(t):
    return r.jn_receta(t.recetas(), _nombres_venta(t))


vista("v_explosion", """
SELECT f.producto, f.fecha, q.plato, q.ingrediente, q.cantidad, q.unidad, f.prediccion,
       COALESCE(TRY_CAST(q.cantidad AS DOUBLE), 0) * f.prediccion AS cantidad_total
FROM v_pronostico f JOIN v_recetas q ON q.plato = f.producto WHERE f.semana_offset = 1""",
      "v_pronostico", "v_recetas")


def _explosion(t):
    f = t.pronostico().filter("semana_offset = 1")
    mapa = r.jn_receta(t.recetas(), f)
    return r.jn_explosion(f, mapa, t.recetas())


@consulta("jn_explosion", "SELECT producto, fecha, plato, ingrediente, cantidad, unidad, prediccion, "
                          "cantidad_total FROM v_explosion", dobles="prediccion cantidad_total")
def _(t):
    return _explosion(t).select("producto", "fecha", "plato", "ingrediente", "cantidad", "unidad",
                                "prediccion", "cantidad_total")


@consulta("agg_insumos", "SELECT ingrediente, unidad, SUM(cantidad_total) AS cantidad "
                         "FROM v_explosion GROUP BY 1, 2", dobles="cantidad")
def _(t):
    return r.agg_insumos(_explosion(t))


# ---- invoices ----

# Invoice documents over the lines: each line is an invoice of two items, its goods and a gift of
# quantity 0; lines flagged R have no items, only a total; those flagged N have no cost centre.
vista("v_factura_linea", """
SELECT CAST(l_orderkey AS VARCHAR) AS Consecutivo, CAST(l_shipdate AS DATE) AS Fecha,
  CASE WHEN l_returnflag = 'R' THEN '' WHEN it = 1 THEN CAST(l_partkey AS VARCHAR) ELSE 'G' END
    AS Codigo,
  CASE WHEN l_returnflag = 'R' OR it = 1 AND l_quantity = 1 OR l_quantity = 0 THEN 1
       WHEN it = 1 THEN l_quantity ELSE 1 END AS Cantidad,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice WHEN it = 1 THEN l_extendedprice / l_quantity
       ELSE 5 END AS Precio,
  CASE WHEN l_returnflag = 'R' OR it = 2 THEN 0 ELSE l_tax * 100 + 1 END AS Impuesto,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice
       WHEN it = 1 THEN l_quantity * (l_extendedprice / l_quantity) + l_tax * 100 + 1
       ELSE 5 END AS Total,
  CASE WHEN l_linestatus = 'F' THEN l_returnflag ELSE '' END AS Forma_pago,
  CASE WHEN l_returnflag = 'N' THEN 'Principal' ELSE 'CP' END AS Establecimiento
FROM lineitem, (VALUES (1), (2)) i(it) WHERE it = 1 OR l_returnflag <> 'R'""")


def _paginas(t):
    bandera = F.col("l_returnflag")
    lineas = F.array(
        F.struct(F.col("l_partkey").cast("string").alias("code"),
                 F.lit("Agua cristal 600ml").alias("description"),
                 F.col("l_quantity").alias("quantity"),
                 (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                 F.array(F.struct((F.col("l_tax") * 100).alias("value")),
                         F.struct(F.lit(1.0).alias("value")),
                         F.struct(F.lit(None).cast("double").alias("value"))).alias("taxes")),
        F.struct(F.lit("G").alias("code"), F.lit("(regalo)").alias("description"),
                 F.lit(0.0).alias("quantity"), F.lit(5.0).alias("price"),
                 F.lit(None).cast("array<struct<value:double>>").alias("taxes")))
    pagos = F.when(F.col("l_linestatus") == "F",
                   F.array(F.struct(bandera.alias("payment_method_id"))))
    centro = F.when(bandera != "N", F.struct(F.lit("CP").alias("name")))
    factura = F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_orderkey").cast("string").alias("number"),
        F.col("l_suppkey").cast("string").alias("seller"),
        F.col("l_extendedprice").alias("total"), pagos.alias("payments"),
        centro.alias("cost_center"), F.when(bandera != "R", lineas).alias("items"))
    return t.t("lineitem").select(F.array(factura).alias("results"))


def _facturas(t):
    ruta = ruta_nueva(t.spark, "facturas-json")
    _paginas(t).write.json(ruta)
    return inv.lineas_de_facturas(inv.src_facturas_json(t.spark, ruta))


_FAC = "Consecutivo Fecha Codigo Cantidad Precio Impuesto Total Forma_pago Establecimiento".split()


@consulta("src_facturas_json", "SELECT * FROM v_factura_linea",
          dobles="Cantidad Precio:8 Impuesto:6 Total")
def _(t):
    return inv.normalizar(_facturas(t)).select(*_FAC)


def _anid(clave, cols, sql, dobles=""):
    """One nested-field rule each, straight over the documents, summed up by its outcome."""
    @consulta(clave, sql, dobles=dobles)
    def _(t):
        # In memory: the same documents without the trip through files.
        return cols(inv.lineas_de_facturas(_paginas(t)))


_anid("anid_impuesto", lambda d: d.groupBy("Consecutivo").agg(F.sum("Impuesto").alias("Impuesto")),
      "SELECT Consecutivo, SUM(Impuesto) AS Impuesto FROM v_factura_linea GROUP BY 1", "Impuesto:6")
_anid("anid_pago", lambda d: d.groupBy("Forma_pago").agg(F.count(F.lit(1)).alias("n")),
      "SELECT Forma_pago, COUNT(*) AS n FROM v_factura_linea GROUP BY 1")
_anid("anid_centro", lambda d: d.groupBy("Establecimiento").agg(F.count(F.lit(1)).alias("n")),
      "SELECT Establecimiento, COUNT(*) AS n FROM v_factura_linea GROUP BY 1")
_anid("anid_linea", lambda d: d.select("Consecutivo", "Codigo", "Cantidad", "Total"),
      "SELECT Consecutivo, Codigo, Cantidad, Total FROM v_factura_linea", "Cantidad Total")

# ---- dedup and ingest: the first half of January is stored, a later overlapping part arrives ----

vista("v_evento", """
SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS Consecutivo,
       CAST(ts AS DATE) AS Fecha, value AS Total FROM events""")
vista("v_nuevo", """
SELECT * FROM v_evento WHERE Fecha >= DATE '2024-01-12' AND Consecutivo NOT IN (
  SELECT Consecutivo FROM v_evento WHERE Fecha < DATE '2024-01-16')""", "v_evento")


def _eventos(t):
    dia = F.col("ts").cast("date")
    return t.t("events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), dia.cast("string")).alias("Consecutivo"),
        dia.alias("Fecha"), F.col("value").alias("Total"))


@consulta("jn_dedup", "SELECT * FROM v_nuevo", dobles="Total")
def _(t):
    e = _eventos(t)
    return j.jn_dedup(e.filter("Fecha >= DATE '2024-01-12'"), e.filter("Fecha < DATE '2024-01-16'"))


def _paginas_eventos(e, ruta):
    """Writes pages of events, their totals quoted, and one page that was cut off."""
    factura = F.struct(F.date_format("Fecha", "yyyy-MM-dd").alias("date"),
                       F.col("Consecutivo").alias("number"),
                       F.col("Total").cast("string").alias("total"))
    e.select(F.array(factura).alias("results")).write.json(ruta)
    rota = e.limit(1).select(F.lit('{"results": [{"date": "2024-01-').alias("value"))
    rota.write.mode("append").text(ruta)


INGESTA = """
SELECT strftime(Fecha, '%Y-%m') AS mes, Consecutivo, Fecha, Total FROM v_evento
WHERE Fecha < DATE '2024-01-16'
UNION ALL SELECT strftime(Fecha, '%Y-%m'), Consecutivo, Fecha, Total FROM v_nuevo"""


@consulta("stm_ingesta", INGESTA, dobles="Total")
def _(t):
    e = _eventos(t)
    base = ruta_nueva(t.spark, "ingesta")
    for parte, filtro in (("a", "Fecha < DATE '2024-01-16'"), ("b", "Fecha >= DATE '2024-01-12'")):
        _paginas_eventos(e.filter(filtro), f"{base}/entrada/{parte}")
        # The same stream is started after each landing and takes what is new to it.
        ingest.stm_ingesta(t.spark, f"{base}/entrada/*", f"{base}/ledger",
                           f"{base}/control").awaitTermination()
    return ingest.guardado(t.spark, f"{base}/ledger").select("mes", "Consecutivo", "Fecha", "Total")


@consulta("snk_append", """
SELECT lote, mes, COUNT(*) AS filas, SUM(Total) AS Total FROM (
  SELECT 'l-1' AS lote, strftime(Fecha, '%Y-%m') AS mes, Total FROM v_evento
  WHERE Fecha < DATE '2024-01-16'
  UNION ALL SELECT 'l-2', strftime(Fecha, '%Y-%m'), Total FROM v_nuevo) x GROUP BY 1, 2
UNION ALL SELECT unnest(['l-1', 'l-2', 'l-3']), 'rechazo', 1, 0""", dobles="Total")
def _(t):
    # Batch form, the second landing handed in twice: the repeat adds nothing.
    e = _eventos(t)
    ledger = ruta_nueva(t.spark, "ledger")
    nuevas = e.filter("Fecha >= DATE '2024-01-12'")
    previas = e.filter("Fecha < DATE '2024-01-16'")
    for lote, parte in (("1", previas), ("2", nuevas), ("3", nuevas)):
        pagina = f"{ledger}-paginas-{lote}"
        _paginas_eventos(parte, pagina)
        ingest.ingerir(inv.src_facturas_json(t.spark, pagina), ledger, lote)
    filas = ingest.guardado(t.spark, ledger).groupBy("lote", "mes").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("Total").alias("Total"))
    malas = t.spark.read.parquet(ingest.rechazos(ledger)).groupBy("lote").agg(
        F.count(F.lit(1)).alias("filas"))
    return j.set_union(filas, malas.select("lote", F.lit("rechazo").alias("mes"), "filas",
                                           F.lit(0.0).alias("Total")))


# ---- marts, from the stand-in forecasts ----


def _marts(t):
    h = t.historial()
    resumen = p.agg_prec_prod(h).select(
        "producto", F.col("semanas").alias("n_semanas"), F.lit(None).alias("fecha_proxima_semana"),
        F.col("mae").alias("mae_hibrido"), *[F.lit(None).alias(c) for c in (
            "prediccion", "prophet_solo", "smape_hibrido", "mae_prophet", "mejora_mae",
            "std_residual")])
    carpeta = ruta_nueva(t.spark, "marts")
    snk.snk_marts({
        "predicciones_top10": resumen,
        "predicciones_4_semanas": t.pronostico().withColumn("prophet_solo", F.col("prediccion")),
        "historial_walkforward": h,
        "precios_unitarios": p.agg_precio(t.ventas()),
    }, carpeta)
    n = t.pronostico().select(F.count_distinct("producto").alias("n_productos"))
    snk.snk_meta(t.spark, carpeta, n, "2026-05-03T15:06:57")
    return carpeta


@consulta("snk_marts", """
SELECT 'historial_walkforward' AS mart, COUNT(*) AS filas, SUM(prediccion) AS total FROM v_historial
UNION ALL SELECT 'precios_unitarios', COUNT(*), SUM(precio_unitario) FROM v_precios
UNION ALL SELECT 'predicciones_4_semanas', COUNT(*), SUM(prediccion) FROM v_pronostico
UNION ALL SELECT 'predicciones_top10', COUNT(*), SUM(m) FROM (
  SELECT AVG(ABS("real" - prediccion)) AS m FROM v_historial GROUP BY producto) x""",
          dobles="total")
def _(t):
    m = sm.src_marts(t.spark, _marts(t))
    medida = {"historial_walkforward": "prediccion", "precios_unitarios": "precio_unitario",
              "predicciones_4_semanas": "prediccion", "predicciones_top10": "mae_hibrido"}
    return j.set_union(*[
        m[k].select(F.lit(k).alias("mart"), F.col(c).alias("x")).groupBy("mart").agg(
            F.count(F.lit(1)).alias("filas"), F.sum("x").alias("total"))
        for k, c in medida.items()])


@consulta("src_marts", "SELECT * EXCLUDE (confianza_pct), prediccion AS prophet_solo, "
                       "confianza_pct FROM v_pronostico",
          dobles="prediccion prediccion_lower prediccion_upper prophet_solo")
def _(t):
    return sm.src_marts(t.spark, _marts(t))["predicciones_4_semanas"]


@consulta("src_meta", "SELECT '2026-05-03T15:06:57' AS ultima_actualizacion, "
                      "COUNT(DISTINCT producto) AS n_productos, "
                      "'2026-05-03 15:06' AS fecha_modelo FROM v_pronostico")
def _(t):
    carpeta = ruta_nueva(t.spark, "meta")
    n = t.pronostico().select(F.count_distinct("producto").alias("n_productos"))
    snk.snk_meta(t.spark, carpeta, n, "2026-05-03T15:06:57")
    return sm.src_meta(t.spark, carpeta)


@consulta("snk_meta", "SELECT '2026-05-03T15:06:57' AS ultima_actualizacion, "
                      "COUNT(DISTINCT producto) AS n_productos FROM v_pronostico")
def _(t):
    carpeta = ruta_nueva(t.spark, "meta")
    n = t.pronostico().select(F.count_distinct("producto").alias("n_productos"))
    snk.snk_meta(t.spark, carpeta, n, "2026-05-03T15:06:57")
    return t.spark.read.schema(esquemas.METADATOS).json(f"{carpeta}/metadata")
