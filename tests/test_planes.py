"""Plans keep their shape: what must be pushed down is, and nothing falls back to a product."""

import contextlib
import io

import __spark_entry__ as entrada
import pytest
from despensa.operators import filters as f
from despensa.sinks.marts import snk_append
from pyspark.sql import functions as F

# Queries with a one-row side by nature (a scalar beside an aggregate) are not listed.
SIN_PRODUCTO = [
    "agg_producto", "agg_granularidad", "agg_mes_local", "jn_margen", "agg_kpi", "agg_tipo",
    "agg_top", "agg_dia", "agg_precio_historia", "jn_ingreso", "agg_plan4", "ts_serie",
    "ts_features", "win_semana_acad", "jn_rango_festivo", "st_acf", "st_pacf", "jn_receta",
    "jn_explosion", "jn_dedup", "jn_busqueda", "src_recetas", "win_bfill", "win_ffill",
]


def plan(df) -> str:
    salida = io.StringIO()
    with contextlib.redirect_stdout(salida):
        df.explain("formatted")
    return salida.getvalue()


@pytest.mark.parametrize("clave", SIN_PRODUCTO)
def test_sin_producto_cartesiano(spark, sf, clave):
    p = plan(entrada.queries()[clave](spark, sf))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p  # no row-at-a-time Python


def test_lee_solo_sus_columnas(spark, sf):
    p = plan(entrada.queries()["agg_producto"](spark, sf))
    lee = [x for x in p.splitlines() if "ReadSchema" in x]
    assert lee and not any("l_comment" in x or "l_suppkey" in x or "o_orderkey" in x for x in lee)


def test_libro_por_mes(spark, sf, tmp_path):
    """Filters on the stored ledger reach its folders and its row groups."""
    d = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("Consecutivo"),
        F.col("o_orderdate").cast("date").alias("Fecha"),
        F.lit("Principal").alias("Establecimiento"), F.col("o_totalprice").alias("Total"))
    snk_append(d, str(tmp_path / "libro"), lote="1")
    libro = spark.read.parquet(str(tmp_path / "libro"))
    assert libro.count() == d.count()
    r = f.flt_rango(libro, "1997-03", "1997-05", "Principal").groupBy("Consecutivo").agg(F.sum("Total"))
    p = plan(r)
    assert "PartitionFilters" in p and "mes" in p.split("PartitionFilters")[1].splitlines()[0]
    pushed = p.split("PushedFilters")[1].splitlines()[0]
    assert "Fecha" in pushed and "Establecimiento" in pushed
    assert r.count() == d.filter("Fecha >= '1997-03-01' AND Fecha < '1997-06-01'").count()


def test_una_pasada_por_producto(spark, sf):
    """The features of all products need one shuffle by product after the weekly sums."""
    p = plan(entrada.queries()["win_rolling"](spark, sf))
    assert p.count("Exchange hashpartitioning") + p.count("hashpartitioning(producto") <= 4


# Queries whose library functions store a table on the way: their plan is looked at without the cut.
CON_CORTES = ["ts_serie", "ts_features", "win_rolling", "agg_top", "agg_pivote", "agg_detalle", "jn_receta",
              "win_cola"]


@pytest.mark.parametrize("clave", CON_CORTES)
def test_plan_antes_del_corte(spark, sf, monkeypatch, clave):
    import sys

    for nombre, modulo in list(sys.modules.items()):
        if nombre.startswith("despensa.") and hasattr(modulo, "cortar"):
            monkeypatch.setattr(modulo, "cortar", lambda df: df)
    p = plan(entrada.queries()[clave](spark, sf))
    assert "Scan parquet" in p  # the files, not a stored result
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p


def test_serie_filtra_antes_de_llenar(spark):
    from despensa.operators.series import ts_serie

    v = spark.createDataFrame([("a", "2024-01-02", 1.0), ("b", "2024-01-20", 2.0), (None, "2024-02-20", 1.0)],
                              "Nombre string, Fecha string, Cantidad double").withColumn("Fecha", F.to_date("Fecha"))
    solo = spark.createDataFrame([("b",)], "producto string")
    d = [(x["producto"], str(x["ds"]), x["y"]) for x in ts_serie(v, solo).orderBy("ds").collect()]
    assert d[0] == ("b", "2024-01-01", 0.0) and d[-1][1] == "2024-02-19" and len(d) == 8
    assert d[2] == ("b", "2024-01-15", 2.0)


def test_top_cuenta_solo_sus_facturas(spark):
    from despensa.operators.panel import agg_top

    v = spark.createDataFrame([("a", 5.0, 1.0, "1", 5.0), ("a", 5.0, 1.0, "1", 5.0), ("b", 20.0, 2.0, "2", 10.0),
                               ("c", 1.0, 1.0, "3", 1.0), (None, 99.0, 1.0, "4", 9.0)],
                              "Nombre string, Total double, Cantidad double, Consecutivo string, Precio double")
    d = [(x["Nombre"], x["Ingresos"], x["Facturas"]) for x in agg_top(v, 2).collect()]
    assert d == [("b", 20.0, 1), ("a", 10.0, 1)]
