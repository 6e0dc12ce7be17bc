"""Weekly series, windows and splits."""

import datetime as dt

from despensa.operators import filters as f
from despensa.operators import series as s
from despensa.operators.horizon import percentil80, ts_confianza, ts_intervalo, ts_seleccion
from pyspark.sql import functions as F

D = dt.date


def ledger(spark):
    filas = [("a", D(2024, 1, 3), 2.0), ("a", D(2024, 1, 7), 1.0), ("a", D(2024, 1, 29), 4.0),
             ("b", D(2024, 1, 17), 5.0), (None, D(2024, 2, 14), 9.0), ("b", None, 1.0)]
    return spark.createDataFrame(filas, "Nombre string, Fecha date, Cantidad double")


def test_serie(spark):
    r = s.ts_serie(ledger(spark)).orderBy("producto", "ds").collect()
    lunes = [D(2024, 1, 1) + dt.timedelta(weeks=k) for k in range(7)]
    # The range is that of all rows, the nameless one included.
    assert [(x["producto"], x["ds"], x["y"]) for x in r] == (
        [("a", d, y) for d, y in zip(lunes, [3, 0, 0, 0, 4, 0, 0])]
        + [("b", d, y) for d, y in zip(lunes, [0, 0, 5, 0, 0, 0, 0])])


def larga(spark, n=60, producto="a"):
    ini = D(2024, 1, 1)
    return spark.createDataFrame([(producto, ini + dt.timedelta(weeks=k), float((k * 7) % 11))
                                  for k in range(n)], "producto string, ds date, y double")


def test_ventanas(spark):
    d = s.win_rolling(s.win_lags(larga(spark, 10)))
    r = d.orderBy("ds").collect()
    ys = [x["y"] for x in r]
    for k, x in enumerate(r):
        assert x["lag_1"] == (ys[k - 1] if k else None)
        assert x["rolling_4"] == (sum(ys[k - 4:k]) / 4 if k >= 4 else None)
        assert x["rolling_8"] == (sum(ys[k - 8:k]) / 8 if k >= 8 else None)


def test_rezago_tras_cierre(spark):
    d = s.win_lags(f.flt_cierre(larga(spark)))
    fila = d.filter("ds = DATE '2025-01-06'").first()
    previa = d.filter("ds = DATE '2024-09-30'").first()
    assert fila["lag_1"] == previa["y"]


def test_cortes(spark):
    r = s.win_corte(larga(spark, 43)).groupBy("parte").agg(
        F.count(F.lit(1)).alias("n"), F.min("ds").alias("a"), F.max("ds").alias("b")).collect()
    p = {x["parte"]: x for x in r}
    assert p["train"]["n"] == 34 and p["train"]["b"] < p["test"]["a"]
    tres = s.win_corte(larga(spark, 5), (0.65, 0.80), ("train", "val", "test"))
    assert [x["parte"] for x in tres.orderBy("ds").collect()] == ["train"] * 3 + ["val", "test"]
    mini = s.win_corte(larga(spark, 4), (0.65, 0.80), ("train", "val", "test"))
    # 65 % and 80 % of 4 weeks give 2 and 3: no fall-back; with 2 weeks both give 1.
    assert [x["parte"] for x in mini.orderBy("ds").collect()] == ["train", "train", "val", "test"]
    g = s.win_folds(larga(spark, 11)).orderBy("ds").collect()
    assert [x["pliegue"] for x in g] == [None] * 5 + [1, 1, 2, 2, 3, 3]


def test_minimos(spark):
    d = larga(spark, 39, "corta").unionByName(larga(spark, 40, "justa"))
    assert {x[0] for x in f.flt_minimos(d, 40).select("producto").distinct().collect()} == {"justa"}
    e = f.flt_cortas(d, 40, "serie muy corta").collect()
    assert [(x["producto"], x["n_semanas"], x["error"]) for x in e] == [
        ("corta", 39, "serie muy corta")]


def test_expandir(spark):
    r = s.set_expandir(larga(spark, 3), 4).orderBy("ds").collect()
    assert len(r) == 7 and all(x["ds"].weekday() == 0 for x in r) and r[-1]["y"] is None


def test_bandas(spark):
    d = spark.createDataFrame(
        [(1, 10.0, 4.0, 2.0), (2, 10.0, 0.0, 2.0), (4, 1.0, None, 2.0)],
        "semana_offset int, prediccion double, p80 double, std_residual double")
    r = ts_intervalo(d).orderBy("semana_offset").collect()
    assert [(round(x["prediccion_lower"], 6), round(x["prediccion_upper"], 6)) for x in r] == [
        (6.0, 14.0), (7.7, 12.3), (0.0, 3.9)]
    c = spark.range(1, 9).select(ts_confianza("id")).collect()
    assert [x[0] for x in c] == [80, 73, 66, 59, 52, 50, 50, 50]
    e = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 2.0), ("b", 4.0)],
                              "p string, e double")
    assert {x[0]: x[1] for x in e.groupBy("p").agg(percentil80("e")).collect()} == {
        "a": None, "b": 3.2}
    m = spark.createDataFrame([(1.0, 2.0, 5.0, 7.0), (2.0, 2.0, 5.0, 7.0), (None, 2.0, 5.0, 7.0)],
                              "mae_hibrido double, mae_base double, h double, b double")
    assert [x["elegida"] for x in ts_seleccion(m, "h", "b").collect()] == [5.0, 7.0, 7.0]
