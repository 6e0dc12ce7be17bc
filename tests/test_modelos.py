"""Model jobs on small series with a known shape."""

import datetime as dt
import math

import numpy as np
import pytest
from despensa.operators import baseline as bl
from despensa.operators import boost as bo
from despensa.operators import diagnostics as dg
from despensa.operators import series as s
from despensa.operators.calendar import calendario_semanal
from despensa.plans.forecast import Opciones, ts_orquestar
from despensa.soporte import cortar
from pyspark.sql import functions as F

INI = dt.date(2025, 1, 6)
PRUEBA = {"prueba": 0, "arboles": 3, "paso": 0.2, "profundidad": 2, "muestra": 1.0,
          "columnas": 1.0, "minimo_hoja": 1}


def recta(spark, n=70, extra=0):
    filas = [("recta", INI + dt.timedelta(weeks=k), 50.0 + k if k < n else None)
             for k in range(n + extra)]
    return spark.createDataFrame(filas, "producto string, ds date, y double")


def test_base_recupera_recta(spark):
    d = recta(spark, 70, 4)
    sem = calendario_semanal(spark, INI, INI + dt.timedelta(weeks=80))
    r = bl.ts_base(d, sem, entero=False).orderBy("ds").collect()
    assert len(r) == 74
    for k, x in enumerate(r):
        assert abs(x["yhat"] - (50 + k)) < 2.0, (k, x)
        assert x["yhat_lower"] <= x["yhat"] <= x["yhat_upper"]


@pytest.mark.parametrize("modo", ["additive", "multiplicative"])
def test_base_festivo(modo):
    n = 120
    dias = np.arange(n) * 7.0 + 20000
    fest = [["f"] if k % 10 == 3 else [] for k in range(n)]
    y = np.array([100.0 + 0.2 * k + (40 if k % 10 == 3 else 0) for k in range(n)])
    efec, nf = bl.efectos(dias, fest, np.ones(n, bool))
    p = {**bl.POR_DEFECTO, "seasonality_mode": modo}
    ajuste, sd = bl.ajustar_serie(dias, y, efec, nf, p)
    assert nf == 1 and np.abs(ajuste - y).max() < 4 and sd < 2


def test_un_quiebre():
    """One planted bend: the prior gathers it where it is, a squared penalty smears it over its neighbours."""
    n, ruido = 150, np.random.default_rng(2).normal(0, 0.5, 150)
    dias = np.arange(n) * 7.0 + 20000
    y = 100.0 + np.clip(np.arange(n) - 57, 0, None) * 1.5 + ruido
    efec = np.zeros((n, 0))
    p = {**bl.POR_DEFECTO, "changepoint_range": 0.95}
    ajuste, _, q = bl.ajustar(dias, y, efec, 0, p)
    vueltas = bl.VUELTAS
    try:
        bl.VUELTAS = 1
        _, _, cresta = bl.ajustar(dias, y, efec, 0, p)
    finally:
        bl.VUELTAS = vueltas

    def junto(q):
        """Share of the two bends beside the planted one."""
        return np.sort(np.abs(q))[-2:].sum() / np.abs(q).sum()

    assert junto(q) > 0.9 > 0.5 > junto(cresta) and np.abs(ajuste - (y - ruido)).max() < 2
    lugar = int(np.abs(q).argmax())
    assert abs((lugar + 1) / bl.QUIEBRES * 0.95 - 57 / n) < 0.06


def test_banda_crece():
    n = 120
    dias = np.arange(n + 10) * 7.0 + 20000
    y = np.r_[100.0 + np.clip(np.arange(n) - 60, 0, None) * 2 + np.random.default_rng(1).normal(0, 1, n), np.full(10, np.nan)]
    _, banda, _ = bl.ajustar(dias, y, np.zeros((n + 10, 0)), 0, bl.POR_DEFECTO)
    assert len(set(banda[:n])) == 1 and (np.diff(banda[n - 1:]) > 0).all()
    _, recta, _ = bl.ajustar(dias, y, np.zeros((n + 10, 0)), 0, bl.POR_DEFECTO, 0, 0.0)
    assert len(set(recta)) == 1  # without bends nothing says that the trend may turn


def test_pruebas():
    a, b = bl.pruebas_base(20), bl.pruebas_base(20)
    assert a == b and len({p["prueba"] for p in a}) == 20
    for p in a:
        assert all(lo <= p[k] <= hi for k, lo, hi, _ in bl.RANGOS)
    for p in bo.pruebas_boost(30):
        assert 100 <= p["arboles"] <= 600 and 2 <= p["profundidad"] <= 7 and .5 <= p["muestra"] <= 1


def test_ajuste_base(spark):
    sem = calendario_semanal(spark, INI, INI + dt.timedelta(weeks=80))
    cero = recta(spark).withColumns({"producto": F.lit("cero"), "y": F.when(
        F.col("ds") < INI + dt.timedelta(weeks=50), F.col("y")).otherwise(0.0)})
    d = s.win_corte(recta(spark).unionByName(cero))
    r = bl.ts_ajuste_base(d, sem, bl.pruebas_base(4))
    m = {x["producto"]: x for x in bl.agg_mejor_prueba(r, *bl.COLS_PARAMS).collect()}
    assert r.count() == 8 and m["cero"]["mae"] == bl.FALLO and m["cero"]["prueba"] == 0
    assert m["recta"]["mae"] < 15


@pytest.fixture(scope="module")
def filas(spark):
    """Two products whose residual depends on the month alone."""
    f = []
    for p, esc in (("a", 1.0), ("b", 10.0)):
        for k in range(66):
            ds = INI + dt.timedelta(weeks=k)
            f.append((p, ds, esc * (20.0 + (6 if ds.month % 2 else -6)), esc * 20.0))
    d = spark.createDataFrame(f, "producto string, ds date, y double, yhat double")
    fin = INI + dt.timedelta(weeks=66)
    r = s.ts_features(d.drop("yhat"), INI, fin).join(d.drop("y"), ["producto", "ds"])
    r = r.withColumns({"yhat_lower": F.col("yhat") * 0.9, "yhat_upper": F.col("yhat") * 1.1})
    return cortar(bo.preparar(r))


def test_preparar(filas):
    r = filas.filter("producto = 'b'").orderBy("i").collect()
    assert len(r) == 58 and r[0]["i"] == 1 and r[0]["corte"] == 46  # eight weeks feed the lags
    y = [x["y"] for x in r[:46]]
    assert abs(r[0]["escala"] - sum(y) / 46) < 1e-9


def test_holdout(filas):
    m = {x["producto"]: x for x in bo.met_holdout(bo.ts_holdout(filas, PRUEBA)).collect()}
    for p in "ab":
        assert m[p]["n_test"] == 12 and m[p]["mae_hibrido"] < m[p]["mae_prophet"]
    # The shared model is scale-free: ten times the sales give ten times the error.
    assert abs(m["b"]["mae_hibrido"] - 10 * m["a"]["mae_hibrido"]) < 1e-6


def test_pasos(spark, filas):
    uno = bo.ts_wf_paso1(filas, PRUEBA, reajuste=4)
    assert uno.count() == 24 and uno.filter("prediccion < 0").count() == 0
    corte = filas.filter(F.col("i") == F.col("corte")).agg(F.max("ds")).first()[0]
    assert uno.filter(F.col("ds") <= F.lit(corte)).count() == 0
    # One week per re-fit over the last weeks, the strict form.
    d, n = bo._tramos(filas, 1)
    assert n == 12 and bo._antes(d, 3, 1).filter(F.col("tramo") >= 3).count() == 0
    multi = cortar(bo.ts_wf_multi(filas, PRUEBA, 4, 6))
    assert multi.groupBy("h").count().filter("count <> 18").count() == 0  # 9 origins x 2 products
    assert multi.filter("ds <> date_add(origen, (h - 1) * 7)").count() == 0
    assert bo.cuantiles_h(multi).filter("p80 IS NULL").count() == 0


def test_horizonte(filas):
    modelo = bo.ts_boost(filas, PRUEBA)
    nodos = bo.ajustes_wf(filas, [PRUEBA], cuales={(0, -1)})
    fut = filas.filter(F.col("i") > F.col("n") - 4).withColumn("ds", F.date_add("ds", 28))
    h = bo.ts_horizonte(filas.select("producto", "ds", "y", "escala"), fut, nodos, prueba=PRUEBA)
    r = h.orderBy("producto", "semana_offset").collect()
    assert [x["semana_offset"] for x in r] == [1, 2, 3, 4] * 2
    assert all(x["prediccion"] >= 0 for x in r)
    assert all(abs(b["prediccion"] - 10 * a["prediccion"]) < 1e-6 for a, b in zip(r[:4], r[4:]))
    # Step 1 is the plain prediction with the last eight weeks as history.
    ult = filas.filter("producto = 'a'").orderBy(F.col("ds").desc()).limit(8).collect()
    ys = [x["y"] for x in ult]
    fila = fut.filter("producto = 'a'").orderBy("ds").limit(1).withColumns({
        "lag_1": F.lit(ys[0]), "lag_2": F.lit(ys[1]), "lag_4": F.lit(ys[3]),
        "rolling_4": F.lit(sum(ys[:4]) / 4), "rolling_8": F.lit(sum(ys) / 8)})
    assert abs(bo.predecir(fila, modelo).first()["prediccion"] - r[0]["prediccion"]) < 1e-9


def test_corrida(spark):
    """A whole run: a product too short to model is reported, the others get four weeks."""
    g = np.random.default_rng(1)
    filas = []
    for p, nivel in (("A", 40), ("B", 30), ("C", 3)):
        for k in range(70):
            filas.append((f"{p}{k}", INI + dt.timedelta(weeks=k, days=2), p, float(nivel + g.poisson(8)),
                          5.0, "Principal"))
    d = spark.createDataFrame(filas, "Consecutivo string, Fecha date, Nombre string, "
                                     "Cantidad double, Precio double, Establecimiento string")
    d = d.withColumn("Total", F.col("Cantidad") * F.col("Precio"))
    o = Opciones(pruebas_base=2, pruebas_boost=[PRUEBA], reajuste=7)
    r = ts_orquestar(d, o)
    res = r["predicciones_top10"].collect()
    assert {x["producto"] for x in res} <= {"A", "B"} and res
    assert all(x["n_semanas"] == 70 and x["fecha_proxima_semana"] == INI + dt.timedelta(weeks=70)
               for x in res)
    c = r["predicciones_4_semanas"].collect()
    assert len(c) == 4 * len(res)
    assert all(0 <= x["prediccion_lower"] <= x["prediccion"] <= x["prediccion_upper"] for x in c)
    assert {x["precio_unitario"] for x in r["precios_unitarios"].collect()} == {5.0}
    corta = ts_orquestar(d, Opciones(pruebas_base=2, pruebas_boost=[PRUEBA], reajuste=7,
                                     minimo_serie=71))["errores"]
    assert {x["error"] for x in corta.collect()} == {"serie muy corta"}


def test_chi2():
    # Known upper tails of the chi-square distribution.
    for x, gl, p in ((3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05),
                     (11.070497693516351, 5, 0.05), (23.209251158954356, 10, 0.01)):
        assert math.isclose(dg.cola_chi2(x, gl), p, rel_tol=1e-9)


def test_funciones_viajan_solas(tmp_path):
    """Executors do not have the package: group functions must load without it."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    ruta = tmp_path / "f.pkl"
    ruta.write_bytes(cloudpickle.dumps((bl.ajustar_serie, bl.efectos, dg.cola_chi2)))
    codigo = ("import pickle, sys; fs = pickle.load(open(sys.argv[1], 'rb')); "
              "assert 'despensa' not in sys.modules; print(fs[2](0.0, 3))")
    r = subprocess.run([sys.executable, "-c", codigo, str(ruta)], cwd=tmp_path, text=True,
                       capture_output=True, env={"PATH": "/usr/bin:/bin"})
    assert r.returncode == 0 and r.stdout.strip() == "1.0", r.stderr
