"""Cleaning rules on the rows that break naive versions."""

import datetime as dt

import pytest
from despensa.functions import dates as fd
from despensa.functions import numbers as num
from despensa.functions import text as tx
from despensa.operators import calendar as oc
from despensa.operators import filters as f
from despensa.operators import segment as sg
from despensa.sources import calendar as cal
from pyspark.sql import functions as F


def una(spark, valores, expr):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(valores)], "i int, x string")
    return [r[0] for r in d.orderBy("i").select(expr).collect()]


def test_nombres(spark):
    entra = ["Arma tu plato Grande(21k)", "Agua con gas Cristal 600ml", "Agua cristal 600ML", "(21k)",
             None, "  Jugo  verde 9OZ ", "Parfaits", "Bowl (a) y (b)", "Té (uno)\n(dos) x"]
    sale = ["Arma tu plato", "Agua con gas Cristal", "Agua sin Gas", "(21k)", None, "Jugo verde",
            "Parfait Frutos Rojos", "Bowl", "Té x"]
    assert una(spark, entra, tx.cln_nombre("x")) == sale
    assert una(spark, ["PASTEL de pollo"], tx.cln_nombre("x", True)) == ["Pastel de pollo"]


def test_acentos(spark):
    assert una(spark, ["  SÁNDWICH  Ñandú\t é", None, "é Ǻ"], tx.cln_acentos("x")) == [
        "sandwich nandu e", "", "e a"]


def test_venta_y_variantes(spark):
    assert una(spark, ["Sándwich Romano (18k)", "Bowl Pollo tostada Mediana"],
               tx.cln_venta("x")) == ["romano", "pollo tostada mediana"]
    assert una(spark, ["pollo veggie mediana", "x"], tx.cln_variantes("x")) == [
        ["pollo veggie mediana", "pollo veggie", "pollo", "pollo veggie mediano"], ["x"]]


def test_platos(spark):
    entra = ["Bowl Pollo tostada", "Chocolate Caliente", "Mexi", "Café", None, "Ensalada bowl"]
    assert una(spark, entra, tx.cat_plato("x")) == ["Bowl", "Desayuno", "Sándwich", "Bebida",
                                                    "Otros", "Bowl"]
    assert una(spark, ["FV-1", "FV-2", "FV-3", "FV-4", "FV-9"], tx.cat_local("x")) == [
        "Principal", "Eventos", "Eventos", "CP", None]


def test_numeros(spark):
    assert una(spark, ["$1.234,56", None, "", "$ 5"], num.cln_moneda("x")) == [1234.56, 0, 0, 5]
    assert una(spark, ["x", "2.5", None], num.cln_numero("x")) == [0, 2.5, 0]
    d = spark.createDataFrame([(None, 2.0, 5.0), ("7", 2.0, 5.0)], "t string, q double, p double")
    assert [tuple(r) for r in d.select(num.cln_total("t", "q", "p"),
                                       num.cln_total("t", "q", "p", "cero")).collect()] == [
        (10.0, 0.0), (7.0, 7.0)]
    r = spark.range(1).select(num.num_redondeo(F.lit(0.25), 1), num.num_redondeo(F.lit(2.5)),
                              num.num_recorte(F.lit(-3.2)), num.num_recorte(F.lit(3.2))).first()
    assert tuple(r) == (0.2, 2.0, 0, 4)


def test_fechas(spark):
    entra = ["2024-02-29", "29/02/2024", "31/02/2024", "2024-01-05 10:20:00", "2024-01-05T10:20:00",
             "x", None]
    d = dt.date
    assert una(spark, entra, fd.cln_fecha("x", fd.DIA_PRIMERO)) == [
        d(2024, 2, 29), d(2024, 2, 29), None, d(2024, 1, 5), d(2024, 1, 5), None, None]
    entra = ["2024-1-5", "29/02/2024", "9999-12-31", "1677-09-21", "2262-04-11", "2024-02-30"]
    assert una(spark, entra, fd.cln_fecha("x")) == [d(2024, 1, 5), None, None, None, d(2262, 4, 11), None]


def test_redondeo_como_el_valor_binario(spark):
    import random
    g = random.Random(1)
    xs = [0.15, 0.25, 0.35, 0.45, 2.675, 1.005, -0.15, -2.5, 0.5, 1.5, 1e300, 0.0, 123456789.125, 1e15 + 0.3]
    xs += [round(g.uniform(-1e4, 1e4), g.randint(0, 4)) for _ in range(2000)]
    xs += [g.randint(-10**6, 10**6) / 8 for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select(
        "x", *[num.num_redondeo("x", n).alias(f"r{n}") for n in (0, 1, 2, 3)])
    for r in df.collect():
        for n in (0, 1, 2, 3):
            assert r[f"r{n}"] == round(r["x"], n), (r["x"], n)


def test_nulos_fuera_de_grupos(spark):
    d = spark.createDataFrame([(None, 1.0, 2.0), ("a", 1.0, 2.0), ("b", 0.0, 3.0)],
                              "Nombre string, Cantidad double, Total double")
    filas = {r["Nombre"]: r["precio_promedio"] for r in sg.agg_producto(d).collect()}
    assert filas == {"a": 2.0, "b": None}


# Runs of the academic week, first Monday and value, as worked out by hand from the calendar.
SEMANAS = {
    "2024-01-15": 0, "2024-01-22": 1, "2024-03-11": 8, "2024-03-18": 0, "2024-03-25": 0,
    "2024-04-01": 9, "2024-05-20": 16, "2024-05-27": 17, "2024-06-03": -1, "2024-07-29": -1,
    "2024-08-05": 1, "2024-09-23": 8, "2024-09-30": 0, "2024-10-07": 9, "2024-11-25": 16,
    "2024-12-02": 17, "2024-12-09": 18, "2024-12-30": 21, "2025-01-06": -1, "2025-01-13": -1,
    "2025-01-20": 1, "2025-03-10": 8, "2025-03-17": 0, "2025-03-24": 9, "2025-04-07": 11,
    "2025-04-14": 0, "2025-04-21": 12, "2025-05-19": 16, "2025-05-26": 17, "2025-08-04": 1,
    "2025-09-29": 0, "2025-11-24": 16, "2025-12-01": 17, "2026-01-12": -1, "2026-01-19": 1,
    "2026-03-23": 9, "2026-03-30": 0, "2026-04-06": 10, "2026-05-18": 16, "2026-08-03": 1,
    "2026-11-23": 16, "2026-11-30": 17, "2026-12-07": -1,
}


def test_semana_academica(spark):
    s = oc.calendario_semanal(spark, dt.date(2024, 1, 1), dt.date(2026, 12, 31))
    hay = {r["ds"].isoformat(): r["semana_academica"] for r in s.collect()}
    assert {k: hay[k] for k in SEMANAS} == SEMANAS
    assert len(hay) == 157


def test_calendario(spark):
    c = cal.src_calendario(spark)
    assert {r["holiday"]: r["dias"] for r in oc.agg_calendario(c).collect()} == {
        "semana_santa": 21, "semana_receso_verano": 18, "examenes_finales": 36,
        "vacaciones_verano": 192, "semana_receso_invierno": 18, "vacaciones_invierno": 132,
        "cierre_oct_dic_2024": 92, "induccion_pregrado": 18}
    assert c.select("ds").distinct().count() == 477
    verano = F.lit(dt.date(2024, 6, 2))
    s = oc.lunes_entre(spark, dt.date(2024, 4, 29), dt.date(2024, 6, 10)).orderBy("ds").select(
        fd.fec_antes_verano("ds", verano))
    assert [r[0] for r in s.collect()] == [0, 1, 2, 3, 4, 0, 0]


@pytest.mark.parametrize("dia", ["2024-01-08", "2024-03-25", "2024-03-28", "2024-05-13",
                                 "2024-06-03", "2024-06-10", "2024-07-01", "2025-06-30"])
def test_festivos(spark, dia):
    dias = {r["ds"].isoformat() for r in cal.src_festivos(spark, 2024, 2025).collect()}
    assert dia in dias and len(dias) in (35, 36)


def test_cierre_y_solape(spark):
    s = oc.lunes_entre(spark, dt.date(2024, 9, 1), dt.date(2025, 1, 20))
    abiertas = [r["ds"] for r in f.flt_cierre(s).orderBy("ds").collect()]
    assert not [d for d in abiertas if d.year == 2024 and d.month >= 10]
    assert dt.date(2024, 9, 30) in abiertas
    p = f.flt_solape(cal.bloques(spark), F.lit(dt.date(2024, 3, 20)), F.lit(dt.date(2024, 3, 26)))
    assert sorted((r["ini"], r["fin"]) for r in p.collect()) == [
        (dt.date(2024, 3, 20), dt.date(2024, 3, 23)), (dt.date(2024, 3, 24), dt.date(2024, 3, 26))]
