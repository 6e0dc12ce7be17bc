"""The table of nodes predicts what the fitted models predict."""

import datetime as dt
import math

import pytest
from despensa.operators import arboles as ar
from despensa.operators import boost as bo
from despensa.operators import series as s
from despensa.soporte import cortar
from pyspark.sql import functions as F

INI = dt.date(2025, 1, 6)
PRUEBA = {"prueba": 0, "arboles": 12, "paso": 0.2, "profundidad": 4, "muestra": 0.7, "columnas": 0.6, "minimo_hoja": 2}


@pytest.fixture(scope="module")
def filas(spark):
    f = []
    for k, p in enumerate("abc"):
        for i in range(66):
            ds = INI + dt.timedelta(weeks=i)
            f.append((p, ds, 20.0 + 7 * math.sin(i * (k + 1)) + (6 if ds.month % 2 else -6) + i * k % 5, 20.0 + k))
    d = spark.createDataFrame(f, "producto string, ds date, y double, yhat double")
    fin = INI + dt.timedelta(weeks=66)
    r = s.ts_features(d.drop("yhat"), INI, fin).join(d.drop("y"), ["producto", "ds"])
    r = r.withColumns({"yhat_lower": F.col("yhat") * 0.9, "yhat_upper": F.col("yhat") * 1.1})
    return cortar(bo.preparar(r))


def por_clave(df, columna="prediccion", claves=("producto", "ds")):
    return {tuple(r[c] for c in claves): r[columna] for r in df.collect()}


def iguales(a, b):
    assert a.keys() == b.keys() and a
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9, abs_tol=1e-9) for k in a)


@pytest.mark.parametrize("pares", [2_000_000, 7])
def test_nodos_como_transform(spark, filas, monkeypatch, pares):
    monkeypatch.setattr(ar, "PARES", pares)
    modelo = bo.ts_boost(filas, PRUEBA)
    nodos = ar.nodos_de(modelo, spark, 3)
    assert nodos.select("arbol").distinct().count() == 12
    iguales(por_clave(bo.con_prediccion(filas.withColumn("ajuste", F.lit(3).cast("bigint")), nodos)),
            por_clave(bo.predecir(filas, modelo)))


def test_grupos_cortados_dan_lo_mismo(spark, filas, monkeypatch):
    """Rows of one fit in many groups, several fits in one plan, a fit without rows."""
    pruebas = [PRUEBA, {**PRUEBA, "prueba": 1, "profundidad": 2}]
    modelos = [bo.ts_boost(filas, p) for p in pruebas]
    nodos = ar.ajustar_todos(spark, [(k, lambda m=m: m) for k, m in enumerate([*modelos, modelos[0]])])
    d = filas.withColumn("ajuste", (F.dayofyear("ds") % 2).cast("bigint"))
    monkeypatch.setattr(ar, "FILAS", 10)
    dicho = por_clave(bo.con_prediccion(d, nodos))
    for k, modelo in enumerate(modelos):
        suyas = por_clave(bo.predecir(d.filter(F.col("ajuste") == k), modelo))
        iguales({x: dicho[x] for x in suyas}, suyas)
    assert len(dicho) == filas.count()
    assert bo.con_prediccion(d.filter("ajuste > 9"), nodos).count() == 0


def test_prefijos_como_ajustes_separados(filas):
    """One fit scores every number of trees as separate fits would."""
    cuentas = [2, 7, 12]
    pruebas = [{**PRUEBA, "prueba": k, "arboles": n} for k, n in enumerate(cuentas)]
    assert [len(g) for g in bo._estructuras(pruebas)] == [3]
    juntas = por_clave(bo.ts_ajuste_boost(filas, pruebas), "mae", ("producto", "prueba"))
    for p in pruebas:
        sola = por_clave(bo.ts_ajuste_boost(filas, [p]), "mae", ("producto", "prueba"))
        iguales({k: juntas[k] for k in sola}, sola)


def test_busqueda_con_menos_arboles():
    pruebas = bo.pruebas_boost(30)
    assert len(pruebas) == 30 and [p["prueba"] for p in pruebas] == list(range(30))
    grupos = bo._estructuras(pruebas)
    assert len(grupos) == 10 and all(len(g) == 3 for g in grupos)
    assert sum(max(p["arboles"] for p in g) for g in grupos) < sum(p["arboles"] for p in pruebas) / 1.8
    for p in pruebas:
        assert 0 <= p["alfa"] <= 2 and 0.5 <= p["lambda"] <= 5 and len(p) == 9
    assert len(bo._estructuras(bo.pruebas_boost(30, cuentas=1))) == 30


def test_busqueda_como_bucle(filas):
    """All trials and folds in one plan, as a loop over fits and folds."""
    p = {**PRUEBA, "arboles": 5}
    d = cortar(s.win_folds(filas.filter("i <= corte").drop("i", "n"), 3))
    maes = {}
    for f in (1, 2, 3):
        modelo = bo.ts_boost(d.filter(F.coalesce("pliegue", F.lit(0)) < f), p)
        for r in bo.predecir(d.filter(F.col("pliegue") == f), modelo).groupBy("producto").agg(
                F.avg(F.abs(F.col("y") - F.col("prediccion"))).alias("mae")).collect():
            maes.setdefault((r["producto"], 0), []).append(r["mae"])
    iguales(por_clave(bo.ts_ajuste_boost(filas, [p]), "mae", ("producto", "prueba")),
            {k: sum(v) / len(v) for k, v in maes.items()})


def test_pasos_como_bucle(filas):
    """Multi-step rows against a loop that feeds predictions back, one origin and step at a time."""
    p = {**PRUEBA, "arboles": 4}
    multi = por_clave(bo.ts_wf_multi(filas, p, 3, 5), "prediccion", ("producto", "origen", "h"))
    d, n = bo._tramos(filas, 5)
    modelos = [bo.ts_boost(bo._antes(d, t, 5), p) for t in range(n)]
    todas = {}
    for r in d.orderBy("ds").collect():
        todas.setdefault(r["producto"], []).append(r)
    origenes = [k for k in multi if k[2] == 1][::4]
    for producto, origen, _ in origenes:
        serie = todas[producto]
        i = next(j for j, r in enumerate(serie) if r["ds"] == origen)
        hist = [r["y"] for r in serie[:i]]
        for h in (1, 2, 3):
            r = serie[i + h - 1].asDict()
            ult = hist[-8:]
            r |= {"lag_1": ult[-1], "lag_2": ult[-2], "lag_4": ult[-4], "rolling_4": sum(ult[-4:]) / 4,
                  "rolling_8": sum(ult) / 8}
            fila = filas.sparkSession.createDataFrame([r], d.schema)
            dicho = bo.predecir(fila, modelos[serie[i]["tramo"]]).first()["prediccion"]
            assert math.isclose(multi[producto, origen, h], dicho, rel_tol=1e-9), (producto, origen, h)
            hist.append(dicho)


def test_plan_no_crece_con_los_ajustes(filas):
    """One plan, whatever the number of origins."""
    p = {**PRUEBA, "arboles": 2, "profundidad": 2}
    largos = []
    for reajuste in (12, 3):
        plan = bo.ts_wf_multi(filas, p, 4, reajuste)._jdf.queryExecution().optimizedPlan().toString()
        largos.append(len(plan.splitlines()))
    assert largos[0] == largos[1] < 60


def test_hojas_encogidas(spark, filas):
    """Leaf weights of a regularised first tree, against the sums of the rows in each leaf."""
    p = {**PRUEBA, "arboles": 1, "paso": 1.0, "muestra": 1.0, "columnas": 1.0}
    crudos = ar.nodos_de(bo.ts_boost(filas, p), spark)
    nodos = ar.encoger(crudos, {0: (0.7, 3.0)})
    hojas = {r["nodo"]: r for r in crudos.collect() if r["rasgo"] < 0}
    assert len(hojas) > 3
    for r in nodos.filter("rasgo < 0").collect():
        suma, n = hojas[r["nodo"]]["valor"] * hojas[r["nodo"]]["n"], hojas[r["nodo"]]["n"]
        assert math.isclose(r["valor"], math.copysign(max(abs(suma) - 0.7, 0), suma) / (n + 3), abs_tol=1e-12)
    con = bo.con_prediccion(filas.withColumn("ajuste", F.lit(0).cast("bigint")), ar.encoger(crudos, {0: (0.0, 0.0)}))
    iguales(por_clave(con), por_clave(bo.con_prediccion(filas.withColumn("ajuste", F.lit(0).cast("bigint")), crudos)))
    # The sums themselves, from the rows: residuals of each leaf on the product's scale.
    caidas = bo.con_prediccion(filas.withColumn("ajuste", F.lit(0).cast("bigint")), crudos)
    medias = {round((r["prediccion"] - r["yhat"]) / r["escala"], 9) for r in caidas.collect() if r["prediccion"] > 0}
    assert medias <= {round(h["valor"], 9) for h in hojas.values()}


def test_importancia_por_cortes(spark, filas):
    nodos = ar.nodos_de(bo.ts_boost(filas, PRUEBA), spark)
    dicha = {r["feature"]: r for r in bo.met_importancia(nodos).collect()}
    por = {}
    for r in nodos.filter("rasgo >= 0").collect():
        por.setdefault(s.FEATURES[r["rasgo"]], []).append(r["n"] * r["ganancia"])
    assert dicha.keys() == por.keys()
    for c, v in por.items():
        assert math.isclose(dicha[c]["importancia"], sum(v) / len(v)) and dicha[c]["usos"] == len(v)
    assert math.isclose(sum(r["parte"] for r in dicha.values()), 1.0)


def test_historia_corta(spark, filas):
    """A product with fewer than eight weeks behind it: inputs it lacks count 0, as the source fills them."""
    p = {**PRUEBA, "arboles": 3}
    nodos = bo.ajustes_wf(filas, [p], cuales={(0, -1)})
    fut = filas.filter(F.col("i") > F.col("n") - 4)
    pocas = filas.filter("i <= 2").select("producto", "ds", "y", "escala")
    r = bo.ts_horizonte(pocas, fut, nodos, prueba=p).filter("semana_offset = 1").collect()
    assert len(r) == 3
    for x in r:
        y = [q["y"] for q in pocas.filter(F.col("producto") == x["producto"]).orderBy("ds").collect()]
        fila = fut.filter((F.col("producto") == x["producto"]) & (F.col("ds") == x["fecha"])).withColumns({
            "lag_1": F.lit(y[-1]), "lag_2": F.lit(y[-2]), "lag_4": F.lit(None).cast("double"),
            "rolling_4": F.lit(None).cast("double"), "rolling_8": F.lit(None).cast("double")})
        assert math.isclose(bo.predecir(fila, bo.ts_boost(filas, p)).first()["prediccion"], x["prediccion"], rel_tol=1e-9)


def test_pruebas_comparten_ajustes(filas, monkeypatch):
    """Trials of one structure are one fit an origin; each gives what it gives alone."""
    pruebas = [{**PRUEBA, "arboles": 2}, {**PRUEBA, "prueba": 1, "arboles": 5}, {**PRUEBA, "prueba": 2, "profundidad": 2, "alfa": 0.1}]
    hechos, ajustar = [], bo.ajustar_todos
    monkeypatch.setattr(bo, "ajustar_todos", lambda spark, tareas: hechos.append(len(tareas)) or ajustar(spark, tareas))
    elegida = F.when(F.col("producto") == "a", 0).when(F.col("producto") == "b", 1).otherwise(2)
    suyas = cortar(filas.withColumn("prueba", elegida))
    usados = bo.ajustes_usados(suyas, 6, 3)
    nodos = bo.ajustes_wf(filas, pruebas, 6, cuales=usados)
    juntas = por_clave(bo.ts_wf_multi(suyas, None, 3, 6, nodos=nodos), "prediccion", ("producto", "origen", "h"))
    assert len(usados) == 9 and hechos == [6]
    for p, producto in zip(pruebas, "abc"):
        sola = por_clave(bo.ts_wf_multi(filas, p, 3, 6).filter(F.col("producto") == producto), "prediccion", ("producto", "origen", "h"))
        iguales({k: juntas[k] for k in sola}, sola)
