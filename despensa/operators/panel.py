"""Aggregates behind the business panel."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from despensa.functions.dates import fec_lunes, fec_periodos
from despensa.functions.numbers import num_participacion
from despensa.functions.text import REGLAS_PLATO, cat_plato
from despensa.soporte import acumular, cortar, dimension, sin_nulos

# ---- fixed values: weekdays in order ----
DIAS = [("Monday", "Lun"), ("Tuesday", "Mar"), ("Wednesday", "Mie"), ("Thursday", "Jue"),
        ("Friday", "Vie"), ("Saturday", "Sab"), ("Sunday", "Dom")]
# -----------------------------------------

GRANOS = {"Dia": "yyyy-MM-dd", "Semana": "yyyy-MM-dd", "Mes": "yyyy-MM"}


def periodo(fecha: str, grano: str) -> Column:
    if grano == "Semana":
        return F.date_format(fec_lunes(fecha), GRANOS[grano])
    return F.date_format(F.col(fecha), GRANOS[grano])


def agg_granularidad(df: DataFrame, valor: str, grano: str = "Mes", por: str | None = None,
                     agg: str = "sum", fecha: str = "Fecha") -> DataFrame:
    """Sum, mean or distinct count of a column by day, week or month and a second key."""
    f = {"sum": F.sum, "mean": F.avg, "nunique": F.count_distinct}.get(agg, F.sum)
    claves = [periodo(fecha, grano).alias("Periodo"), *([F.col(por)] if por else [])]
    if por:
        df = sin_nulos(df, por)
    return df.groupBy(*claves).agg(f(valor).alias(valor))


def agg_mes_local(ventas: DataFrame) -> DataFrame:
    return agg_granularidad(ventas, "Total", "Mes", "Establecimiento")


def agg_mes(df: DataFrame, valor: str) -> DataFrame:
    return agg_granularidad(df, valor, "Mes")


def jn_margen(ventas: DataFrame, costos: DataFrame, grano: str = "Mes") -> DataFrame:
    """Revenue against cost by period; a period one side lacks counts as 0 there."""
    i = agg_granularidad(ventas, "Total", grano).withColumnRenamed("Total", "Ingresos")
    c = agg_granularidad(costos, "Valor", grano).withColumnRenamed("Valor", "Costos")
    return (i.join(c, "Periodo", "full").na.fill(0.0, ["Ingresos", "Costos"])
            .withColumn("Margen", F.col("Ingresos") - F.col("Costos")))


def agg_utilidad(ventas: DataFrame, costos: DataFrame) -> DataFrame:
    m = jn_margen(ventas, costos, "Mes")
    return m.select("Periodo", F.col("Ingresos").alias("Total_ventas"),
                    F.col("Costos").alias("Total_compras"), F.col("Margen").alias("Utilidad"))


def win_crec(ventas: DataFrame) -> DataFrame:
    """Growth of the last month present over the one present before it, in percent.

    Works on one row per month, so the global window is small by nature.
    """
    w = Window.orderBy("Periodo")
    return (
        agg_mes(ventas, "Total")
        .withColumn("previo", F.lag("Total").over(w))
        .select(
            F.max_by("Periodo", "Periodo").alias("mes"),
            F.coalesce(F.max_by(F.try_divide(F.col("Total") - F.col("previo"), F.col("previo"))
                                * 100, "Periodo"), F.lit(0.0)).alias("crec_mes"),
        )
    )


def agg_kpi(ventas: DataFrame, costos: DataFrame) -> DataFrame:
    """Revenue, invoices, units, mean ticket, cost and margin in one row.

    The ticket is a two-level aggregate. Invoices are summed first (keyed by invoice, partial sums
    before the shuffle) and that table answers revenue, units and invoice count as well, so the
    ledger is read once.
    """
    factura = ventas.groupBy("Consecutivo").agg(F.sum("Total").alias("t"),
                                                F.sum("Cantidad").alias("q"))
    v = factura.agg(
        F.sum("t").alias("ingresos"), F.count("Consecutivo").alias("n_fact"),
        F.sum("q").alias("unidades"),
        F.avg(F.when(F.col("Consecutivo").isNotNull(), F.col("t"))).alias("ticket_prom"),
    )
    gasto = F.coalesce(costos.select(F.sum("Valor")).scalar(), F.lit(0.0))
    return (
        v.withColumn("total_gasto", gasto)
        .withColumn("margen", F.col("ingresos") - F.col("total_gasto"))
        .withColumn("margen_pct", F.when(F.col("ingresos") > 0,
                                         F.col("margen") / F.col("ingresos") * 100).otherwise(0.0))
    )


def agg_tipo(ventas: DataFrame, tipo: str = "TipoPlato") -> DataFrame:
    """By dish type: revenue, units, invoices, share of revenue and ticket."""
    t = sin_nulos(ventas, tipo).groupBy(tipo).agg(
        F.sum("Total").alias("Ingresos"), F.sum("Cantidad").alias("Unidades"),
        F.count_distinct("Consecutivo").alias("Facturas"))
    todo = F.sum("Ingresos").over(Window.partitionBy(F.lit(1)))  # one row per dish type
    return (t.withColumn("Participacion", num_participacion("Ingresos", todo))
            .withColumn("TicketProm", num_participacion("Ingresos", "Facturas", 1.0)))


def _por_producto(ventas: DataFrame, reglas) -> DataFrame:
    """One row per product. The dish type follows from the name, so it is worked out once per
    product instead of once per line."""
    t = sin_nulos(ventas, "Nombre").groupBy("Nombre").agg(
        F.sum("Total").alias("Ingresos"), F.sum("Cantidad").alias("Unidades"),
        F.count_distinct("Consecutivo").alias("Facturas"), F.avg("Precio").alias("Precio_prom"))
    return t.withColumn("TipoPlato", cat_plato("Nombre", reglas))


def agg_top(ventas: DataFrame, n: int = 12, reglas=REGLAS_PLATO) -> DataFrame:
    """The n products with most revenue; each task keeps n rows, no full sort.

    The n are found by sums alone; only their invoices are shuffled to be counted.
    """
    v = sin_nulos(ventas, "Nombre")
    mejores = cortar(v.groupBy("Nombre").agg(
        F.sum("Total").alias("Ingresos"), F.sum("Cantidad").alias("Unidades"),
        F.avg("Precio").alias("Precio_prom"))
        .orderBy(F.col("Ingresos").desc(), "Nombre").limit(n))
    facturas = v.join(F.broadcast(mejores.select("Nombre")), "Nombre", "left_semi") \
        .groupBy("Nombre").agg(F.count_distinct("Consecutivo").alias("Facturas"))
    return (mejores.join(facturas, "Nombre").withColumn("TipoPlato", cat_plato("Nombre", reglas))
            .select("Nombre", "Ingresos", "Unidades", "Facturas", "Precio_prom", "TipoPlato")
            .orderBy(F.col("Ingresos").desc(), "Nombre"))


def agg_detalle(ventas: DataFrame, reglas=REGLAS_PLATO) -> DataFrame:
    """Every product with its share of revenue.

    The product table is stored and its total, one number, read off it: the ledger is scanned once
    and no window gathers all products.
    """
    t = cortar(_por_producto(ventas, reglas))
    todo = t.agg(F.sum("Ingresos")).first()[0]
    return t.withColumn("Pct", num_participacion("Ingresos", F.lit(todo).cast("double")))


def agg_dia(ventas: DataFrame) -> DataFrame:
    """Revenue and invoices by weekday, all seven present."""
    v = ventas.groupBy(F.weekday("Fecha").alias("n")).agg(
        F.sum("Total").alias("Ingresos"), F.count_distinct("Consecutivo").alias("Facturas"))
    dias = dimension(ventas.sparkSession, n=(pa.int32(), list(range(7))),
                     DiaSemana=(pa.string(), [d for d, _ in DIAS]),
                     Dia=(pa.string(), [c for _, c in DIAS]))
    return dias.join(v, "n", "left").select("n", "DiaSemana", "Dia", "Ingresos", "Facturas")


def agg_pivote(ventas: DataFrame, meses: Sequence[str] | None = None) -> DataFrame:
    """Weekday by month revenue matrix. Weekday-month sums are made once and stored; the months, a
    list as long as the calendar, are read off that small table when not given."""
    v = cortar(ventas.groupBy(F.weekday("Fecha").alias("n"), periodo("Fecha", "Mes").alias("Mes"))
               .agg(F.sum("Total").alias("t")))
    if meses is None:
        meses = [r[0] for r in v.select("Mes").distinct().orderBy("Mes").collect()]
    dia = F.element_at(F.array(*[F.lit(c) for _, c in DIAS]), F.col("n") + 1)
    return (v.groupBy(dia.alias("Dia")).pivot("Mes", list(meses)).agg(F.sum("t"))
            .na.fill(0.0))


def agg_proveedor(costos: DataFrame, n: int = 10) -> DataFrame:
    return (sin_nulos(costos, "Proveedor").groupBy("Proveedor").agg(F.sum("Valor").alias("Valor"))
            .orderBy(F.col("Valor").desc(), "Proveedor").limit(n))


def agg_semana(ventas: DataFrame) -> DataFrame:
    """Units by product and Monday week."""
    return (sin_nulos(ventas, "Nombre")
            .groupBy(F.col("Nombre").alias("producto"), fec_lunes("Fecha").alias("ds"))
            .agg(F.sum("Cantidad").alias("y")))


def agg_precio(ventas: DataFrame, dias: int | None = None) -> DataFrame:
    """Price weighted by units over all history, or over the last ``dias`` days with all history
    as fallback.

    The recent form sums by product and day first and stores that table: the newest date and both
    sums come from it, so the ledger is scanned once.
    """
    v = sin_nulos(ventas, "Nombre")
    sumas = [F.sum(F.col("Precio") * F.col("Cantidad")).alias("p"), F.sum("Cantidad").alias("q"),
             F.count(F.lit(1)).alias("n")]
    uno = F.lit(1.0)
    if dias is None:
        return (v.groupBy(F.col("Nombre").alias("producto")).agg(*sumas)
                .select("producto", (F.col("p") / F.greatest("q", uno)).alias("precio_unitario")))
    diario = cortar(v.groupBy(F.col("Nombre").alias("producto"), "Fecha").agg(*sumas))
    ultimo = diario.agg(F.max("Fecha")).first()[0]
    reciente = F.col("Fecha") >= F.date_sub(F.lit(ultimo), dias)
    s = diario.groupBy("producto").agg(
        F.sum(F.when(reciente, F.col("n"))).alias("nr"),
        F.sum(F.when(reciente, F.col("p"))).alias("pr"),
        F.sum(F.when(reciente, F.col("q"))).alias("qr"),
        F.sum("p").alias("p"), F.sum("q").alias("q"))
    return s.select("producto", F.when(F.col("nr") > 0, F.col("pr") / F.greatest("qr", uno))
                    .otherwise(F.col("p") / F.greatest("q", uno)).alias("precio_unitario"))


def agg_tendencia(puntos: DataFrame, valor: str, orden: str = "Periodo") -> DataFrame:
    """Least-squares line over the position of each period, given more than three periods."""
    # One row per period: the calendar bounds the window.
    i = F.row_number().over(Window.orderBy(orden)) - 1
    p = puntos.withColumn("i", i)
    todo = Window.partitionBy(F.lit(1))
    return p.select(
        orden, valor,
        F.when(F.count(F.lit(1)).over(todo) > 3,
               F.regr_intercept(F.col(valor), F.col("i")).over(todo)
               + F.regr_slope(F.col(valor), F.col("i")).over(todo) * F.col("i")).alias("tendencia"))


# ---- forecast and accuracy panels ----


def jn_ingreso(pronostico: DataFrame, precios: DataFrame) -> DataFrame:
    """Expected revenue and its band; a product without a price counts as 0."""
    p = pronostico.join(precios, "producto", "left").na.fill(0.0, ["precio_unitario"])
    precio = F.col("precio_unitario")
    return p.withColumns({
        "ingreso": F.col("prediccion") * precio,
        "ingreso_lower": F.col("prediccion_lower") * precio,
        "ingreso_upper": F.col("prediccion_upper") * precio,
    })


def agg_ingreso_sem(ingresos: DataFrame) -> DataFrame:
    return ingresos.groupBy("semana_offset", "fecha", "confianza_pct").agg(
        F.sum("ingreso").alias("ingreso"), F.sum("ingreso_lower").alias("ingreso_lower"),
        F.sum("ingreso_upper").alias("ingreso_upper"))


def agg_plan4(pronostico: DataFrame, precios: DataFrame) -> DataFrame:
    """Units and revenue of each dish over the four weeks."""
    return jn_ingreso(pronostico, precios).groupBy("producto").agg(
        F.sum("prediccion").alias("unidades_total"), F.sum("ingreso").alias("ingreso_total"))


def jn_seguimiento(pronostico: DataFrame, ventas: DataFrame, asof: Column) -> DataFrame:
    """Past forecasts against what was sold; a week without sales has no real value.

    The weeks forecast, two dates, bound the part of the ledger that is read.
    """
    pasadas = pronostico.filter(F.col("fecha") < asof).select("producto", "fecha", "prediccion")
    ini, fin = pasadas.agg(F.min("fecha"), F.date_add(F.max("fecha"), 6)).first()
    tramo = ventas.filter(F.col("Fecha").between(F.lit(ini).cast("date"), F.lit(fin).cast("date")))
    real = agg_semana(tramo).select("producto", F.col("ds").alias("fecha"), "y")
    y = F.when(F.col("y") > 0, F.col("y"))
    return pasadas.join(real, ["producto", "fecha"], "left").select(
        "producto", "fecha", "prediccion", F.floor(y).cast("bigint").alias("real"),
        F.abs(y - F.col("prediccion")).alias("error"))


def agg_mae_vivo(seguimiento: DataFrame) -> DataFrame:
    return seguimiento.agg(F.avg("error").alias("mae_vivo"), F.count("error").alias("semanas"))


def met_error_sem(hist: DataFrame) -> DataFrame:
    return hist.withColumns({"error_abs": F.abs(F.col("real") - F.col("prediccion")),
                             "error_base": F.abs(F.col("real") - F.col("prophet"))})


def agg_prec_prod(hist: DataFrame) -> DataFrame:
    """Error of each product; a product's weeks are few, so the exact median is safe here."""
    e = met_error_sem(hist)
    return e.groupBy("producto").agg(
        F.avg("error_abs").alias("mae"), F.max("error_abs").alias("error_max"),
        F.median("error_abs").alias("error_mediano"), F.count("error_abs").alias("semanas"))


def agg_prec_sem(hist: DataFrame) -> DataFrame:
    """All products pooled by week."""
    return met_error_sem(hist).groupBy("ds").agg(
        F.sum("real").alias("real"), F.sum("prediccion").alias("prediccion"),
        F.sum("error_abs").alias("error_abs"), F.sum("prophet").alias("prophet"))


def win_cola(hist: DataFrame, n: Column | int, ds: str = "ds", nombre: str = "producto") -> DataFrame:
    """The last n rows by date; within a date in md5 order of the name.

    Rows are counted by date first, a table as long as the calendar; later dates are taken whole
    and only the date where n falls is ranked.
    """
    antes = Window.orderBy(F.col("_d").desc()).rowsBetween(Window.unboundedPreceding, -1)
    dias = (hist.filter(F.col(ds).isNotNull()).groupBy(F.col(ds).alias("_d"))
            .agg(F.count(F.lit(1)).alias("_c"))
            .withColumn("_p", F.coalesce(F.sum("_c").over(antes), F.lit(0)))
            .filter(F.col("_p") < n))
    d = hist.join(F.broadcast(dias), F.col(ds) == F.col("_d"))
    enteras = d.filter(F.col("_p") + F.col("_c") <= n)
    borde = acumular(d.filter(F.col("_p") + F.col("_c") > n).withColumn("_uno", F.lit(1)), "_uno",
                     nombre, "_a", "_pos", "_t").filter(F.col("_pos") <= F.lit(n) - F.col("_p"))
    return enteras.select(*hist.columns).unionByName(borde.select(*hist.columns))


def agg_prec_kpi(hist: DataFrame) -> DataFrame:
    """Overall error, error of the last four weeks' worth of rows, share of rows within it."""
    e = cortar(met_error_sem(hist))
    mae, n = e.agg(F.avg("error_abs"), F.count_distinct("producto") * 4).first()
    dentro = (F.col("error_abs") <= F.lit(mae).cast("double")).cast("double")
    ult = win_cola(e, n).agg(F.avg("error_abs").alias("mae_ult4"))
    return e.agg(F.avg("error_abs").alias("mae_total"),
                 (F.avg(dentro) * 100).alias("pct_bien")) \
        .withColumn("mae_ult4", ult.scalar())


def agg_cobertura(serie: DataFrame) -> DataFrame:
    """Weeks of each series: all, with sales, at zero."""
    return serie.groupBy("producto").agg(
        F.count(F.lit(1)).alias("semanas"), F.count_if(F.col("y") > 0).alias("activas"),
        F.count_if(F.col("y") == 0).alias("en_cero"))


def agg_distintos(df: DataFrame, col: str | Column, nombre: str) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(nombre)).filter(F.col(nombre).isNotNull()).distinct().orderBy(nombre)


def agg_auditoria(df: DataFrame, archivo: str = "archivo", fecha: str = "Fecha") -> DataFrame:
    return df.groupBy(archivo).agg(F.min(fecha).alias("desde"), F.max(fecha).alias("hasta"))


def con_periodos(ventas: DataFrame) -> DataFrame:
    return ventas.withColumns(fec_periodos("Fecha"))
