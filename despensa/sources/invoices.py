"""Nested invoice pages to ledger lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa import esquemas
from despensa.functions import nested as n
from despensa.functions.dates import cln_fecha
from despensa.functions.text import cln_nombre

LECTURA = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malo"}


def src_facturas_json(spark: SparkSession, ruta, paginas: bool = False) -> DataFrame:
    """Landed invoice pages. ``paginas`` when each file is one indented document."""
    return (spark.read.schema(esquemas.FACTURAS_JSON).options(**LECTURA).option("multiLine", paginas)
            .json(ruta))


def paginas_malas(paginas: DataFrame) -> DataFrame:
    """Pages that cannot be taken: text that is no JSON document, or one without results."""
    return paginas.filter(F.col("results").isNull()).select(
        F.coalesce("_malo", F.lit("")).alias("texto"), F.lit("results").alias("falta"))


def _numero(c) -> Column:
    return c.cast("string").try_cast("double")


def lineas_de_facturas(paginas: DataFrame) -> DataFrame:
    """One row per item; an invoice without items gives one row with its total.

    Two explodes of arrays inside a row, no shuffle.
    """
    f = paginas.select(F.explode("results").alias("f")).select("f.*")
    vacia = F.coalesce(F.size("items") == 0, F.lit(True))
    d = f.withColumn("it", F.explode_outer("items")).withColumn("vacia", vacia)
    it = F.col("it")
    cantidad, precio = _numero(it["quantity"]), _numero(it["price"])
    impuestos = F.transform(it["taxes"], lambda x: F.struct(_numero(x["value"]).alias("value")))
    total = F.coalesce(_numero(F.col("total")), F.lit(0.0))
    return d.select(
        F.coalesce("number", F.lit("")).alias("Consecutivo"),
        F.col("date").alias("Fecha"),
        F.lit("Secuencia").alias("Tipo_reg"),
        F.lit("").alias("Tipo_clas"),
        F.coalesce(it["code"], F.lit("")).alias("Codigo"),
        F.coalesce(it["description"], F.lit("")).alias("Nombre"),
        F.coalesce("seller", F.lit("")).alias("Vendedor"),
        F.when(F.col("vacia"), 1.0).otherwise(n.anid_cantidad(cantidad)).alias("Cantidad"),
        F.when(F.col("vacia"), total).otherwise(F.coalesce(precio, F.lit(0.0)))
        .alias("Precio"),
        F.when(F.col("vacia"), 0.0).otherwise(n.anid_impuesto(impuestos)).alias("Impuesto"),
        F.when(F.col("vacia"), total)
        .otherwise(n.anid_linea(cantidad, precio, impuestos)).alias("Total"),
        n.anid_pago(F.col("payments")).alias("Forma_pago"),
        F.coalesce("number", F.lit("")).alias("Num_comp"),
        n.anid_centro(F.col("cost_center")).alias("Establecimiento"),
    )


def normalizar(lineas: DataFrame) -> DataFrame:
    """Ledger types, clean names, rows without a date dropped."""
    return (lineas.withColumn("Fecha", cln_fecha("Fecha")).filter(F.col("Fecha").isNotNull())
            .withColumn("Nombre", cln_nombre("Nombre")))
