"""Readers of ledgers, reports, catalogue and recipe sheets exported as text.

Everything is read as strings under a fixed schema and coerced afterwards: no inference pass, and a
value that does not parse becomes null or 0 instead of failing the job. Columns a query does not
use are never parsed (the CSV reader prunes them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa import esquemas
from despensa.functions.dates import DIA_PRIMERO, cln_fecha, fec_periodos
from despensa.functions.numbers import cln_moneda, cln_numero, cln_total
from despensa.functions.text import cat_local, cat_plato, cln_nombre

def _csv(spark: SparkSession, ruta, nombres: list[str], cabecera: bool = True,
         multilinea: bool = False) -> DataFrame:
    """Text under a fixed schema. Files are split among tasks; ``multilinea``, for quoted fields that
    hold line breaks, reads each file in one."""
    return (spark.read.schema(esquemas.texto(nombres))
            .option("header", cabecera).option("enforceSchema", True)
            .option("multiLine", multilinea).option("quote", '"').option("escape", '"')
            .csv(ruta))


def prj_renombrar(df: DataFrame, nombres: list[str]) -> DataFrame:
    """Names by position."""
    return df.toDF(*nombres)


def prj_seleccion(df: DataFrame, mantener: list[str] | None = None,
                  quitar: tuple[str, ...] = ()) -> DataFrame:
    return (df.select(*mantener) if mantener else df).drop(*quitar)


def src_ventas(spark: SparkSession, ruta, total: str = "producto", limpiar: bool = True,
               multilinea: bool = False) -> DataFrame:
    """Sales ledger. ``total`` says what a missing line total becomes (see ``cln_total``)."""
    v = _csv(spark, ruta, esquemas.VENTAS, multilinea=multilinea)
    v = v.withColumn("Fecha", cln_fecha("Fecha")).filter(F.col("Fecha").isNotNull())
    v = v.withColumns({"Cantidad": cln_numero("Cantidad"), "Precio": cln_numero("Precio"),
                       "Impuesto": F.col("Impuesto").try_cast("double")})
    v = v.withColumn("Total", cln_total("Total", "Cantidad", "Precio", total))
    return v.withColumn("Nombre", cln_nombre("Nombre")) if limpiar else v


def src_catalogo(spark: SparkSession, ruta, multilinea: bool = True) -> DataFrame:
    """Product catalogue; names are quoted and may run over several lines."""
    c = _csv(spark, ruta, esquemas.CATALOGO, multilinea=multilinea)
    return c.withColumns({n: F.col(n).try_cast("double")
                          for n in ("Trans", "Cant_total", "Precio_prom", "Ingresos_total")})


def src_compras_csv(spark: SparkSession, ruta, multilinea: bool = False) -> DataFrame:
    """Purchase ledger: line records only, the tax totals between them left out."""
    c = _csv(spark, ruta, esquemas.COMPRAS, multilinea=multilinea)
    return c.filter(F.col("Tipo_reg") == "Secuencia").select(
        cln_fecha("Fecha").alias("Fecha"), F.lit("Compra/Gasto").alias("Tipo"), "Proveedor",
        cln_numero("Total").alias("Valor")).filter(F.col("Fecha").isNotNull())


def _posiciones(spark: SparkSession, ruta, n: int, multilinea: bool) -> DataFrame:
    """Report read by column position. The lines above the table stay in; callers drop them by
    their date, which does not parse."""
    return _csv(spark, ruta, [f"c{i}" for i in range(n)], False, multilinea)


def src_compras_rep(spark: SparkSession, ruta, multilinea: bool = False) -> DataFrame:
    """Purchase reports: type, date, supplier and amount at positions 0, 3, 6 and 8."""
    from despensa.operators.filters import flt_costos
    r = _posiciones(spark, ruta, 9, multilinea)
    r = r.select(cln_fecha("c3", DIA_PRIMERO).alias("Fecha"), F.col("c0").alias("Tipo"),
                 F.col("c6").alias("Proveedor"), cln_numero("c8").alias("Valor"))
    return flt_costos(r.filter(F.col("Fecha").isNotNull()))


def cargar_costos(spark: SparkSession, ruta_informes, ruta_csv) -> DataFrame:
    """Costs of all sources, purchase reports and purchase ledger, with month, week and day."""
    from despensa.operators.joins import set_union
    c = set_union(src_compras_rep(spark, ruta_informes), src_compras_csv(spark, ruta_csv))
    periodos = fec_periodos("Fecha")
    return c.select("Fecha", "Tipo", "Proveedor", "Valor",
                    *[periodos[p].alias(p) for p in ("Mes", "Semana", "Dia")])


def _de_ruta(clave: str, hasta_guion: bool) -> Column:
    """Name a file stands for: from a ``clave=`` folder, else from the file's own name."""
    ruta = F.url_decode("_metadata.file_path")
    # Folder names are escaped once more than the path is.
    carpeta = F.nullif(F.url_decode(F.regexp_extract(ruta, f"/{clave}=([^/]+)/", 1)), F.lit(""))
    tallo = F.regexp_extract(ruta, r"/([^/]+?)(?:\.[^./]*)?$", 1)
    return F.coalesce(carpeta, F.substring_index(tallo, "-", 1) if hasta_guion else tallo)


def src_facturas(spark: SparkSession, ruta, multilinea: bool = False) -> DataFrame:
    """Invoice reports by location: date and total at positions 1 and 13, location from the file
    name up to the first dash, or the whole name without one."""
    r = _posiciones(spark, ruta, 14, multilinea).withColumn("Local", _de_ruta("Local", True))
    r = r.select(cln_fecha("c1", DIA_PRIMERO).alias("Fecha"), cln_moneda("c13").alias("Total"),
                 "Local").filter(F.col("Fecha").isNotNull())
    return r.withColumn("Mes", F.date_format("Fecha", "yyyy-MM"))


# ---- fixed values: columns of the month reports, and what their two ledgers keep ----
REPORTE = ["Consecutivo", "Fecha", "Tipo_reg", "Tipo_clas", "Codigo", "Nombre", "Vendedor",
           "Cantidad", "Precio", "Impuesto", "Total", "Forma_pago", "Num_comp", "Tipo_transaccion"]
REPORTE_COMPRAS = ["Factura", "ID", "Proveedor", "Fecha_m", "Fecha_e", "Contacto", "Fecha_v"]
FECHAS_COMPRAS = ["Fecha_m", "Fecha_e", "Fecha_v"]
VENTA, COMPRA = "Factura de venta", "Factura de compra"
LIBRO_VENTAS = ["Consecutivo", "Fecha", "Codigo", "Nombre", "Vendedor", "Cantidad", "Precio", "Impuesto",
                "Total", "Forma_pago", "Num_comp", "Establecimiento"]
LIBRO_COMPRAS = ["Consecutivo", "Factura", "ID", "Proveedor", "Fecha", "Fecha_m", "Fecha_e", "Contacto",
                 "Tipo_reg", "Tipo_clas", "Codigo", "Nombre", "Cantidad", "Precio", "Total", "Forma_pago",
                 "Fecha_v"]
# -------------------------------------------------------------------------------------


def libro_reportes(spark: SparkSession, ruta, tipo: str = VENTA, multilinea: bool = False) -> DataFrame:
    """Sales or purchase ledger out of the month reports, in one job.

    Rows of one transaction type; the payment method, which stands below the items it belongs to,
    is filled upwards inside each file; rows without a product code, the payment rows, go. Sales
    get their location from the document prefix, purchases their three further dates.
    """
    from despensa.operators.filters import flt_nulos, flt_tipo
    from despensa.operators.ordered import win_bfill
    r = flt_tipo(src_reportes_mes(spark, ruta, multilinea), tipo)
    r = win_bfill(r, "Forma_pago", ["bloque"], "fila", F.col("inicio"))
    r = flt_nulos(r, "Codigo").withColumns({
        "Cantidad": cln_numero("Cantidad"), "Precio": cln_numero("Precio"), "Total": cln_numero("Total")})
    if tipo == COMPRA:
        return r.withColumns({c: cln_fecha(c, DIA_PRIMERO) for c in FECHAS_COMPRAS}).select(*LIBRO_COMPRAS)
    return r.withColumns({"Impuesto": cln_numero("Impuesto"), "Establecimiento": cat_local("Num_comp")}) \
        .select(*LIBRO_VENTAS)


def src_reportes_mes(spark: SparkSession, ruta, multilinea: bool = False) -> DataFrame:
    """Month reports: all files the path matches, absent months simply do not match. The purchase
    columns stand after the sale columns and are null in reports that lack them.

    Rows keep their place (file, block, row), which the payment fill needs; it is the order of the
    file however the scan is split.
    """
    r = _csv(spark, ruta, REPORTE + REPORTE_COMPRAS, False, multilinea)
    r = r.withColumns({
        "archivo": _de_ruta("archivo", False),
        "bloque": F.col("_metadata.file_path"),
        "inicio": F.col("_metadata.file_block_start"),
        "fila": F.monotonically_increasing_id(),
    })
    return r.withColumn("Fecha", cln_fecha("Fecha", DIA_PRIMERO)) \
        .filter(F.col("Fecha").isNotNull())


def src_recetas(spark: SparkSession, ruta, multilinea: bool = False) -> DataFrame:
    """Recipe sheets as one long table. Position 0 holds the row number; the dish and its portion
    stand on the dish's first row only and are carried down."""
    from despensa.operators.recipes import recetas_de_hojas
    r = _csv(spark, ruta, ["fila", "porcion", "receta", "ingrediente", "cantidad", "unidad"],
             False, multilinea)
    return recetas_de_hojas(r.withColumn("hoja", _de_ruta("hoja", False))
                            .withColumn("fila", F.col("fila").try_cast("bigint")))


def cargar_panel(spark: SparkSession, ruta_ventas, ruta_catalogo) -> DataFrame:
    """Ledger as the panel reads it: missing totals 0, dish type, catalogue quadrant."""
    from despensa.operators.joins import jn_catalogo
    v = src_ventas(spark, ruta_ventas, total="cero", limpiar=False)
    v = v.withColumn("TipoPlato", cat_plato("Nombre"))
    return jn_catalogo(v, src_catalogo(spark, ruta_catalogo))


def esq_diferencia(izq: DataFrame, der: DataFrame) -> list[tuple[str, str]]:
    """Which columns are only left, only right or common."""
    a, b = set(izq.columns), set(der.columns)
    return sorted([(c, "izquierda") for c in a - b] + [(c, "derecha") for c in b - a]
                  + [(c, "ambas") for c in a & b])
