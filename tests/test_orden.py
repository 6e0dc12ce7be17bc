"""Distributed ranking, percentiles and fills against brute force, on skewed data."""

import hashlib
import math
import random

import numpy as np
import pytest
from despensa.operators import segment as sg
from despensa.operators.ordered import win_bfill, win_ffill
from despensa.soporte import _contar, acumular, percentiles_exactos
from pyspark.sql import functions as F


def datos(n=3000, semilla=7):
    g = random.Random(semilla)
    # A third of the products share one value, as single sales do.
    return [(f"p{i:05d}", 1.0 if i % 3 == 0 else float(g.choice([2, 5, 9]))
             if i % 3 == 1 else round(g.uniform(0, 1000), 2)) for i in range(n)]


def test_acumular(spark):
    filas = datos()
    d = spark.createDataFrame(filas, "Nombre string, m double").repartition(5)
    r = {x["Nombre"]: x for x in acumular(d, "m", "Nombre").collect()}
    orden = sorted(filas, key=lambda f: (-f[1], hashlib.md5(f[0].encode()).hexdigest(), f[0]))
    suma = 0.0
    for i, (n, m) in enumerate(orden, 1):
        suma += m
        assert r[n]["pos"] == i and abs(r[n]["acum"] - suma) < 1e-6
    assert abs(r["p00000"]["total"] - suma) < 1e-6


@pytest.mark.parametrize("p", [0.25, 0.5, 1.0])
@pytest.mark.parametrize("n", [1, 2, 3000])
def test_percentiles(spark, n, p):
    filas = datos(n)
    d = spark.createDataFrame([(m, -m if m > 3 else None) for _, m in filas], "a double, b double")
    a, b = percentiles_exactos(d, ["a", "b"], p)
    assert abs(a - np.percentile([m for _, m in filas], 100 * p)) < 1e-9
    nb = [-m for _, m in filas if m > 3]
    assert (b is None) if not nb else abs(b - np.percentile(nb, 100 * p)) < 1e-9


def test_percentiles_de_todo_orden(spark):
    """Signs, infinities, tiny and huge values, ties at the rank, a value that holds most rows."""
    g = random.Random(5)
    x = [g.choice([0.0, -0.0, 1e-300, -1e-300, 5e-324, 1e300, -1e300, 7.25]) * g.choice([1, 1, g.random()]) for _ in range(900)]
    x += [7.25] * 2000 + [float("inf"), float("-inf")]
    d = spark.createDataFrame([(v, None) for v in x], "a double, b double").repartition(7)
    for p in (0.0, 0.1, 0.333, 0.5, 0.9):
        a, b = percentiles_exactos(d, ["a", "b"], p)
        orden, lugar = sorted(x), (len(x) - 1) * p
        bajo, alto = orden[math.floor(lugar)], orden[math.ceil(lugar)]
        assert b is None and (a == bajo if bajo == alto else math.isclose(a, bajo + (alto - bajo) * (lugar % 1), rel_tol=1e-12))
    assert percentiles_exactos(d.limit(0), ["a"], 0.5) == [None]
    enteros = spark.range(1001).select((F.col("id") % 10).alias("n"))
    assert percentiles_exactos(enteros, ["n"], 0.5) == [float(np.percentile([i % 10 for i in range(1001)], 50))]


def test_percentil_sin_valores_en_una_tarea(spark):
    """What moves is counters: at most 65,536 a task and column, however many rows and values."""
    d = spark.range(0, 300_000, 1, 3).select(F.rand(3).alias("x"))
    filas = [sum(int((v > 0).sum()) for v in _contar(d, ["x"], [(0, 0)], 0).values())]
    assert filas[0] < 2000  # the first digit: sign, exponent and four bits
    assert "Window" not in d._jdf.queryExecution().toString()


def test_pareto(spark):
    d = spark.createDataFrame(datos(), "Nombre string, m double")
    p = sg.win_pareto(d, "m")
    exc = sg.win_abc(p, regla="exclusiva").filter("Clase_ABC = 'A'")
    cru = sg.win_abc(p, regla="cruce").filter("Clase_ABC = 'A'")
    assert exc.join(cru, "Nombre", "left_anti").count() == 0
    assert cru.count() - exc.count() in (0, 1)
    assert abs(p.agg(F.max("pct_acum")).first()[0] - 1) < 1e-9
    assert sg.win_n80(p).first()[0] == exc.count() + 1


def test_llenado(spark):
    g = random.Random(3)
    filas = [(a, i, g.choice("xyz") if g.random() < 0.02 else None)
             for a in ("f1", "f2") for i in range(1500)]
    d = spark.createDataFrame(filas, "archivo string, fila int, v string").repartition(6)
    tramo = F.floor(F.col("fila") / 50)
    abajo = win_bfill(d, "v", ["archivo"], "fila", tramo)
    arriba = win_ffill(d, F.col("v"), "u", ["archivo"], "fila", tramo)
    b = {(r["archivo"], r["fila"]): r["v"] for r in abajo.collect()}
    u = {(r["archivo"], r["fila"]): r["u"] for r in arriba.collect()}
    for a in ("f1", "f2"):
        vs = [v for x, _, v in filas if x == a]
        for i in range(1500):
            assert b[a, i] == next((v for v in vs[i:] if v), None)
            assert u[a, i] == next((v for v in vs[i::-1] if v), None)


def test_llenado_lineal(spark):
    """One long stretch, and as many short ones: no frame is read anew for every row."""
    n = 40_000
    d = spark.range(n).select(F.lit("f").alias("archivo"), F.col("id").alias("fila"),
                              F.when(F.col("id") % 1000 == 999, F.col("id").cast("string")).alias("v"))
    for tramo in (F.lit(0), F.col("fila")):
        abajo = win_bfill(d, "v", ["archivo"], "fila", tramo)
        arriba = win_ffill(d, F.col("v"), "u", ["archivo"], "fila", tramo)
        for r in (abajo, arriba):
            plan = r._jdf.queryExecution().toString().lower()
            assert "window" in plan and "unboundedfollowing" not in plan
        assert abajo.filter(F.col("v") != (F.floor(F.col("fila") / 1000) * 1000 + 999).cast("string")).count() == 0
        assert abajo.filter("v IS NULL").count() == 0 and arriba.filter("u IS NULL").count() == 999
