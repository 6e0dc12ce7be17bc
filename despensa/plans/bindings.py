"""Ledger, purchases, recipes and weekly series laid over the given tables.

Each view exists twice, as a DataFrame and as the SQL text its results are checked against.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The calendar of 2024-2026 moved back 28 years (1,461 whole weeks) falls on the test tables' years
# with the same weekdays.
DESPLAZAMIENTO = 10227


@dataclass
class Tablas:
    spark: SparkSession
    ruta: str

    def t(self, nombre: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.ruta}/{nombre}.parquet")

    def ventas(self, pago: bool = False) -> DataFrame:
        """Sales ledger. The join to orders is only made when the payment method is wanted."""
        parte = self.t("part").select("p_partkey", F.col("p_name").alias("Nombre"))
        d = self.t("lineitem").join(parte, F.col("l_partkey") == F.col("p_partkey"))
        forma = F.lit(None).cast("string")
        if pago:
            d = d.join(self.t("orders").select("o_orderkey", "o_orderpriority"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
            forma = F.col("o_orderpriority")
        bandera = F.col("l_returnflag")
        return d.select(
            F.col("l_orderkey").cast("string").alias("Consecutivo"),
            F.col("l_shipdate").cast("date").alias("Fecha"),
            F.lit("Secuencia").alias("Tipo_reg"),
            F.lit("").alias("Tipo_clas"),
            F.col("l_partkey").cast("string").alias("Codigo"),
            "Nombre",
            F.col("l_suppkey").cast("string").alias("Vendedor"),
            F.col("l_quantity").alias("Cantidad"),
            F.try_divide("l_extendedprice", "l_quantity").alias("Precio"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("Impuesto"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Total"),
            forma.alias("Forma_pago"),
            F.when(bandera == "A", "FV-1").when(bandera == "N", "FV-4").otherwise("FV-9")
            .alias("Num_comp"),
            F.when(bandera == "A", "Principal").when(bandera == "N", "CP")
            .alias("Establecimiento"),
        )

    def costos_crudos(self) -> DataFrame:
        """Purchases with the payment rows still in."""
        c = self.t("customer").select("c_custkey", F.col("c_mktsegment").alias("Proveedor"))
        e = F.col("o_orderstatus")
        return self.t("orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderdate").cast("date").alias("Fecha"),
            F.when(e == "F", "Compra/Gasto").when(e == "O", "Documento soporte")
            .otherwise("Pago").alias("Tipo"),
            "Proveedor",
            F.col("o_totalprice").alias("Valor"),
        )

    def costos(self) -> DataFrame:
        from despensa.operators.filters import flt_costos
        return flt_costos(self.costos_crudos())

    def recetas(self) -> DataFrame:
        return self.t("part").select(
            F.col("p_type").alias("categoria"), F.col("p_name").alias("plato"),
            F.col("p_size").cast("string").alias("porcion"),
            F.col("p_brand").alias("ingrediente"), F.col("p_size").cast("string").alias("cantidad"),
            F.lit("g").alias("unidad"), F.col("p_partkey").alias("orden"),
        )

    def semanal(self) -> DataFrame:
        from despensa.operators.panel import agg_semana
        return agg_semana(self.ventas())

    def historial(self) -> DataFrame:
        """Stand-in forecasts: last week's value and the mean of the last four."""
        w = Window.partitionBy("producto").orderBy("ds")
        return (
            self.semanal()
            .select(
                "producto", "ds", F.col("y").alias("real"),
                F.lag("y", 1).over(w).alias("prediccion"),
                F.avg("y").over(w.rowsBetween(-4, -1)).alias("prophet"),
                F.row_number().over(w).alias("n"),
            )
            .filter("n > 4").drop("n")
        )

    def pronostico(self) -> DataFrame:
        """Stand-in four-week forecast: the last four sold weeks of each product."""
        w = Window.partitionBy("producto").orderBy(F.col("ds").desc())
        return (
            self.semanal().withColumn("n", F.row_number().over(w)).filter("n <= 4")
            .select(
                "producto", (F.lit(5) - F.col("n")).cast("int").alias("semana_offset"),
                F.col("ds").alias("fecha"), F.col("y").alias("prediccion"),
                (F.col("y") * 0.8).alias("prediccion_lower"),
                (F.col("y") * 1.25).alias("prediccion_upper"),
                (F.lit(80) - (F.lit(4) - F.col("n")) * 7).cast("int").alias("confianza_pct"),
            )
        )


VISTAS = {
    "v_ventas": """
SELECT CAST(l_orderkey AS VARCHAR) AS Consecutivo, CAST(l_shipdate AS DATE) AS Fecha,
       'Secuencia' AS Tipo_reg, '' AS Tipo_clas, CAST(l_partkey AS VARCHAR) AS Codigo,
       p_name AS Nombre, CAST(l_suppkey AS VARCHAR) AS Vendedor, l_quantity AS Cantidad,
       l_extendedprice / l_quantity AS Precio, l_extendedprice * l_tax AS Impuesto,
       l_extendedprice * (1 - l_discount) AS Total, o_orderpriority AS Forma_pago,
       CASE l_returnflag WHEN 'A' THEN 'FV-1' WHEN 'N' THEN 'FV-4' ELSE 'FV-9' END AS Num_comp,
       CASE l_returnflag WHEN 'A' THEN 'Principal' WHEN 'N' THEN 'CP' END AS Establecimiento
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "v_costos_crudos": """
SELECT CAST(o_orderdate AS DATE) AS Fecha,
       CASE o_orderstatus WHEN 'F' THEN 'Compra/Gasto' WHEN 'O' THEN 'Documento soporte'
            ELSE 'Pago' END AS Tipo,
       c_mktsegment AS Proveedor, o_totalprice AS Valor
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_costos": "SELECT * FROM v_costos_crudos WHERE Tipo <> 'Pago'",
    "v_recetas": """
SELECT p_type AS categoria, p_name AS plato, CAST(p_size AS VARCHAR) AS porcion,
       p_brand AS ingrediente, CAST(p_size AS VARCHAR) AS cantidad, 'g' AS unidad,
       p_partkey AS orden
FROM part""",
    "v_semanal": """
SELECT p_name AS producto, CAST(date_trunc('week', l_shipdate) AS DATE) AS ds,
       SUM(l_quantity) AS y
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_name, CAST(date_trunc('week', l_shipdate) AS DATE)""",
    "v_historial": """
SELECT producto, ds, y AS "real", prediccion, prophet FROM (
  SELECT producto, ds, y, LAG(y, 1) OVER (PARTITION BY producto ORDER BY ds) AS prediccion,
         AVG(y) OVER (PARTITION BY producto ORDER BY ds ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
           AS prophet,
         ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds) AS n FROM v_semanal) t
WHERE n > 4""",
    "v_pronostico": """
SELECT producto, CAST(5 - n AS INTEGER) AS semana_offset, ds AS fecha, y AS prediccion,
       y * 0.8 AS prediccion_lower, y * 1.25 AS prediccion_upper,
       CAST(80 - (4 - n) * 7 AS INTEGER) AS confianza_pct
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY producto ORDER BY ds DESC) AS n FROM v_semanal) t
WHERE n <= 4""",
    "v_producto": """
SELECT Nombre, COUNT(Cantidad) AS transacciones, SUM(Cantidad) AS cantidad_total,
       SUM(Total) AS plata_generada, SUM(Total) / SUM(Cantidad) AS precio_promedio
FROM v_ventas GROUP BY Nombre""",
    "v_serie": """
SELECT p.producto, CAST(w.ds AS DATE) AS ds, COALESCE(s.y, 0) AS y
FROM (SELECT DISTINCT producto FROM v_semanal) p
CROSS JOIN (SELECT unnest(generate_series((SELECT MIN(ds) FROM v_semanal),
                                          (SELECT MAX(ds) FROM v_semanal), INTERVAL 7 DAY)) AS ds) w
LEFT JOIN v_semanal s ON s.producto = p.producto AND s.ds = CAST(w.ds AS DATE)""",
}
# Views each view is built on, in the order they must be declared.
_BASE = {
    "v_costos": ["v_costos_crudos"], "v_historial": ["v_semanal"], "v_pronostico": ["v_semanal"],
    "v_producto": ["v_ventas"], "v_serie": ["v_semanal"],
}


def vista(nombre: str, sql: str, *bases: str) -> None:
    """Declares one more view for the checking SQL."""
    VISTAS[nombre] = sql
    if bases:
        _BASE[nombre] = list(bases)


def con(sql: str) -> str:
    """Puts the views a query mentions in front of it."""
    orden: list[str] = []

    def poner(v: str) -> None:
        for b in _BASE.get(v, []):
            poner(b)
        if v not in orden:
            orden.append(v)

    import re
    for v in VISTAS:
        if re.search(rf"\b{v}\b", sql):
            poner(v)
    partes = ",\n".join(f"{v} AS ({VISTAS[v]})" for v in orden)
    # A query may go on with tables of its own, starting with a comma; they may be recursive.
    return (f"WITH RECURSIVE {partes}\n" if partes else "") + sql.strip()
