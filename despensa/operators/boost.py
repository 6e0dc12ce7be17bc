"""Boosted residual model on top of the baseline, back-tests and the recursive horizon.

One gradient-boosted model is fitted over the weeks of all products; levels and residuals are put
on each product's own scale first, so that a slow seller and a best seller can share trees. The
fit itself is distributed and its number does not grow with the catalogue. What was fitted is a table of
nodes (see ``operators.arboles``): searches, back-tests and the horizon are one plan each, however
many fits they use.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from despensa.functions import metrics as m
from despensa.operators.arboles import Ensamble, ajustar_todos, con_nodos, encoger, matriz
from despensa.operators.horizon import percentil80
from despensa.operators.series import FEATURES, con_posicion, flt_modelables, win_folds
from despensa.soporte import carpeta_compartida, cortar, enviar_por_valor

enviar_por_valor(__name__)

# ---- fixed values: search ranges ----
ARBOLES = (100, 600)
PASO = (0.01, 0.25)
PROFUNDIDAD = (2, 7)
FRACCION = (0.5, 1.0)
MINIMO_HOJA = (1, 15)
ALFA = (0.0, 2.0)
LAMBDA = (0.5, 5.0)
# -------------------------------------

NIVELES = ["yhat", "yhat_lower", "yhat_upper", "lag_1", "lag_2", "lag_4", "rolling_4", "rolling_8"]


def pruebas_boost(n: int = 30, semilla: int = 42, arboles: tuple[int, int] = ARBOLES,
                  profundidad: tuple[int, int] = PROFUNDIDAD, cuentas: int = 3) -> list[dict]:
    """Seeded draws from the search ranges. Each draw of the other parameters is tried with ``cuentas``
    numbers of trees, for one fit scores all of them."""
    g = np.random.default_rng(semilla)
    salida: list[dict] = []
    while len(salida) < n:
        otros = {
            "paso": float(np.exp(g.uniform(*np.log(PASO)))),
            "profundidad": int(g.integers(profundidad[0], profundidad[1] + 1)),
            "muestra": float(g.uniform(*FRACCION)),
            "columnas": float(g.uniform(*FRACCION)),
            "minimo_hoja": int(g.integers(MINIMO_HOJA[0], MINIMO_HOJA[1] + 1)),
            "alfa": float(g.uniform(*ALFA)),
            "lambda": float(g.uniform(*LAMBDA)),
        }
        for c in sorted(int(x) for x in g.integers(arboles[0], arboles[1] + 1, cuentas)):
            salida.append({"prueba": len(salida), "arboles": c, **otros})
    return salida[:n]


def preparar(marco: DataFrame, minimo: int = 25, parte: float = 0.80) -> DataFrame:
    """Rows the model can use, with their position, the test cut and the product's scale.

    The scale is the mean of the product's training weeks, so no test week reaches it.
    """
    d = con_posicion(flt_modelables(marco, FEATURES, minimo)).withColumn(
        "corte", F.floor(F.lit(parte) * F.col("n")).cast("int"))
    media = F.avg(F.when(F.col("i") <= F.col("corte"), F.col("y"))).over(
        Window.partitionBy("producto"))
    return d.withColumn("escala", F.greatest(F.coalesce(media, F.lit(1.0)), F.lit(1.0)))


def _entradas(features: Sequence[str], de=F.col) -> list[Column]:
    """Model inputs: levels on the product's scale, missing ones as 0, as the source fills them."""
    return [F.coalesce((de(c) / F.col("escala") if c in NIVELES else de(c)).cast("double"), F.lit(0.0))
            for c in features]


def _vector(df: DataFrame, features: Sequence[str], col: str) -> DataFrame:
    """Model inputs as a vector."""
    e = dict(zip((f"_x_{c}" for c in features), _entradas(features)))
    d = df.withColumns(e)
    return VectorAssembler(inputCols=list(e), outputCol=col).transform(d).drop(*e)


def ts_boost(train: DataFrame, prueba: dict, features: Sequence[str] = FEATURES,
             semilla: int = 42) -> GBTRegressionModel:
    """Fits the residual y - yhat of all products' training rows."""
    carpeta_compartida(train.sparkSession)  # the fit cuts its own lineage there
    d = _vector(train.withColumn("_r", (F.col("y") - F.col("yhat")) / F.col("escala")), features,
                "_f").select("_f", "_r")
    return GBTRegressor(
        featuresCol="_f", labelCol="_r", predictionCol="_p", seed=semilla,
        maxIter=prueba["arboles"], stepSize=prueba["paso"], maxDepth=prueba["profundidad"],
        subsamplingRate=prueba["muestra"], featureSubsetStrategy=str(prueba["columnas"]),
        minInstancesPerNode=prueba["minimo_hoja"],
    ).fit(d)


def predecir(df: DataFrame, modelo: GBTRegressionModel, features: Sequence[str] = FEATURES,
             salida: str = "prediccion") -> DataFrame:
    """Baseline plus predicted residual, never negative."""
    d = modelo.transform(_vector(df, features, "_f"))
    return d.withColumn(salida, F.greatest(
        F.lit(0.0), F.coalesce("yhat", F.lit(0.0)) + F.col("_p") * F.col("escala"))
    ).drop("_f", "_p")


def _regular(prueba: dict) -> tuple[float, float]:
    return prueba.get("alfa", 0.0), prueba.get("lambda", 0.0)


def con_prediccion(filas: DataFrame, nodos: DataFrame, features: Sequence[str] = FEATURES,
                   salida: str = "prediccion") -> DataFrame:
    """``predecir`` by the fit that ``ajuste`` names in each row, out of the table of nodes."""
    def paso(de: pa.Table, e: Ensamble, _: int) -> list:
        return [pa.array(e.predecir(matriz(de.column("_x"))))]

    d = con_nodos(filas.withColumn("_x", F.array(*_entradas(features))), nodos, paso, "_p double")
    return d.withColumn(salida, F.greatest(
        F.lit(0.0), F.coalesce("yhat", F.lit(0.0)) + F.col("_p") * F.col("escala"))).drop("_x", "_p")


def _estructuras(pruebas: Sequence[dict]) -> list[list[dict]]:
    """Trials that differ in the number of trees alone."""
    grupos: dict[tuple, list[dict]] = {}
    for p in pruebas:
        grupos.setdefault(tuple(sorted((k, v) for k, v in p.items() if k not in ("prueba", "arboles"))), []).append(p)
    return list(grupos.values())


def ts_ajuste_boost(filas: DataFrame, pruebas: Sequence[dict], k: int = 3, features: Sequence[str] = FEATURES
                    ) -> DataFrame:
    """Error of every trial on expanding time folds of the training rows, per product.

    Trials that differ in the number of trees alone share one fit a fold, of the largest number: the
    first trees of a boosting are the boosting of fewer trees. All trials and folds are scored by one plan.
    """
    d = cortar(win_folds(filas.filter(F.col("i") <= F.col("corte")).drop("i", "n"), k))
    pliegue = F.coalesce("pliegue", F.lit(0))
    grupos = _estructuras(pruebas)
    pares = [(g * k + f - 1, max(grupo, key=lambda p: p["arboles"]), f)
             for g, grupo in enumerate(grupos) for f in range(1, k + 1)]
    nodos = ajustar_todos(d.sparkSession, [
        (a, lambda p=p, f=f: ts_boost(d.filter(pliegue < f), p, features)) for a, p, f in pares])
    nodos = encoger(nodos, {a: _regular(p) for a, p, _ in pares})
    cuales = [([p["prueba"] for p in g], [p["arboles"] for p in g]) for g in grupos]

    def puntos(de: pa.Table, e: Ensamble, ajuste: int) -> list:
        numeros, cuentas = cuales[ajuste // k]
        p = e.hasta(matriz(de.column("_x")), cuentas)
        corr = de.column("escala").to_numpy().astype(float)[:, None] * p
        return [pa.array([numeros] * len(p), pa.list_(pa.int32())), pa.array(list(corr), pa.list_(pa.float64()))]

    escritas = d.filter("pliegue IS NOT NULL").select(
        F.explode(F.array(*[(F.lit(g * k) + F.col("pliegue") - 1).cast("bigint") for g in range(len(grupos))])).alias("ajuste"),
        "producto", "ds", "pliegue", "y", "yhat", "escala", F.array(*_entradas(features)).alias("_x"))
    dichas = con_nodos(escritas, nodos, puntos, "pruebas array<int>, correccion array<double>").select(
        "producto", "pliegue", "y", "yhat", F.inline(F.arrays_zip("pruebas", "correccion")))
    dichas = dichas.withColumn("prediccion", F.greatest(F.lit(0.0), F.coalesce("yhat", F.lit(0.0)) + F.col("correccion")))
    return cortar(dichas.groupBy("producto", F.col("pruebas").alias("prueba"), "pliegue")
                  .agg(m.met_mae("y", "prediccion").alias("mae"))
                  .groupBy("producto", "prueba").agg(F.avg("mae").alias("mae")))


def ts_holdout(filas: DataFrame, prueba: dict | None = None, features: Sequence[str] = FEATURES,
               nodos: DataFrame | None = None) -> DataFrame:
    """Single fit on the first 80 %, predictions of every test row. ``nodos`` as in ``ts_wf_multi``."""
    d = con_prueba(filas, prueba)
    if nodos is None:
        nodos = ajustes_wf(filas, [prueba], 1, features, {(prueba["prueba"], 0)})
    d = d.filter(F.col("i") > F.col("corte")).withColumn("ajuste", _ajuste(F.lit(0)))
    return con_prediccion(d, nodos, features).select(
        "producto", "ds", F.col("y").alias("real"), "prediccion", F.col("yhat").alias("prophet"))


def met_holdout(test: DataFrame) -> DataFrame:
    """Per product: hybrid error over active weeks, baseline error over all test weeks (as the
    published figures are) and over the same weeks, spread of the active residuals."""
    y, p, b = "real", "prediccion", "prophet"
    residuo = F.when(F.col(y) > 0, F.col(y) - F.col(p))
    return test.groupBy("producto").agg(
        F.count_if(F.col(y) > 0).alias("n_test"),
        m.met_activas(m.met_mae, y, p).alias("mae_hibrido"),
        m.met_activas(m.met_smape, y, p).alias("smape_hibrido"),
        m.met_mae(y, b).alias("mae_prophet"),
        m.met_activas(m.met_mae, y, b).alias("mae_prophet_activas"),
        m.met_mejora(y, b, p).alias("mejora_mae"),
        m.met_mejora(y, b, p, mismas_filas=True).alias("mejora_mismas_filas"),
        F.when(F.count(residuo) > 1, F.stddev_pop(residuo)).otherwise(0.0).alias("std_residual"))


def _tramos(filas: DataFrame, reajuste: int) -> tuple[DataFrame, int]:
    """Stretches of ``reajuste`` test weeks that share one re-fit, and how many there are."""
    k = F.col("i") - F.col("corte") - 1
    d = filas.withColumn("tramo", F.when(k >= 0, F.floor(k / reajuste)).cast("int"))
    return d, (d.agg(F.max("tramo")).first()[0] or 0) + 1


def _antes(d: DataFrame, tramo: int, reajuste: int) -> DataFrame:
    """Rows known when stretch ``tramo`` starts."""
    return d.filter(F.col("i") <= F.col("corte") + F.lit(tramo * reajuste))


# Fits of a back-test by number: a trial's fits follow each other, 0 over all rows, then the stretches.
POR_PRUEBA = 100_000


def _ajuste(tramo: Column | int) -> Column:
    """Number of the fit that predicts a stretch; -1 for the one over all rows."""
    return (F.col("prueba").cast("bigint") * POR_PRUEBA + tramo + 1).cast("bigint")


def con_prueba(filas: DataFrame, prueba: dict | None) -> DataFrame:
    """Each row's trial; with ``prueba`` the same for all, else the rows name it themselves."""
    return filas if prueba is None else filas.withColumn("prueba", F.lit(prueba["prueba"]))


def ajustes_wf(filas: DataFrame, pruebas: Sequence[dict], reajuste: int = 1, features: Sequence[str] = FEATURES,
               cuales: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """Nodes of the fits of a back-test: for every trial one over all rows and one for each stretch of
    ``reajuste`` test weeks, on the weeks before it. ``cuales`` names the pairs (trial, stretch) that
    are needed; -1 stands for all rows. A fit takes the rows of all products, so products share it, as do
    trials that differ in the number of trees alone.
    The fit of stretch 0 knows the training part alone: it is the hold-out model.
    """
    d, n = _tramos(filas, reajuste)
    d = cortar(d)
    por = {p["prueba"]: p for p in pruebas}
    pares = sorted(set(cuales) if cuales is not None else {(p, t) for p in por for t in range(-1, n)})
    # Trials that differ in the number of trees alone are the first trees of one fit.
    grupo = {p["prueba"]: g for g, iguales in enumerate(_estructuras(pruebas)) for p in iguales}
    mayor: dict[tuple[int, int], dict] = {}
    for p, t in pares:
        otro = mayor.get((grupo[p], t))
        mayor[grupo[p], t] = por[p] if otro is None else max(otro, por[p], key=lambda x: x["arboles"])
    nodos = ajustar_todos(d.sparkSession, [
        (g * POR_PRUEBA + t + 1, lambda p=p, t=t: ts_boost(d if t < 0 else _antes(d, t, reajuste), p, features))
        for (g, t), p in mayor.items()])
    reparto = d.sparkSession.createDataFrame(
        [(grupo[p] * POR_PRUEBA + t + 1, p * POR_PRUEBA + t + 1, por[p]["arboles"]) for p, t in pares],
        "ajuste bigint, _de bigint, _arboles int")
    nodos = nodos.join(F.broadcast(reparto), "ajuste").filter("arbol < _arboles").withColumn("ajuste", F.col("_de"))
    return cortar(encoger(nodos, {p * POR_PRUEBA + t + 1: _regular(por[p]) for p, t in pares}))


def ajustes_usados(filas: DataFrame, reajuste: int, horizonte: int) -> set[tuple[int, int]]:
    """Fits that hold-out, multi-step back-test and horizon of these rows ask for, as (trial, stretch):
    at most one for each trial and test week."""
    d, _ = _tramos(filas.filter(F.col("i") <= F.col("n") - horizonte + 1), reajuste)
    usados = {tuple(r) for r in d.filter("tramo IS NOT NULL").select("prueba", "tramo").distinct().collect()}
    todas = {r[0] for r in filas.select("prueba").distinct().collect()}
    return usados | {(p, t) for p in todas for t in (-1, 0)}


def ts_wf_paso1(filas: DataFrame, prueba: dict | None = None, reajuste: int = 1, features: Sequence[str] = FEATURES,
                nodos: DataFrame | None = None) -> DataFrame:
    """Walk-forward: each test week is predicted by a model fitted on weeks before it.

    ``reajuste=1`` fits anew for every week; a larger number re-fits every that many weeks. Either
    way every test week of every product is predicted. A baseline of 0 forces 0. ``nodos`` are those of
    ``ajustes_wf``, fitted here if not given.
    """
    d = cortar(con_prueba(filas, prueba))
    d, n = _tramos(d, reajuste)
    if nodos is None:
        nodos = ajustes_wf(filas, [prueba], reajuste, features, {(prueba["prueba"], t) for t in range(n)})
    d = con_prediccion(d.filter("tramo >= 0").withColumn("ajuste", _ajuste(F.col("tramo"))), nodos, features)
    return d.select(
        "producto", "ds", F.col("y").alias("real"),
        F.when(F.col("yhat") == 0, 0.0).otherwise(F.col("prediccion")).alias("prediccion"),
        F.col("yhat").alias("prophet"))


def _fijas(features: Sequence[str]) -> list[str]:
    return [c for c in features if not c.startswith(("lag_", "rolling_"))]


def _fila(features: Sequence[str], yhat: str = "yhat") -> Column:
    """What a step needs of its week: the inputs that do not come from the history, and the baseline."""
    fijas = _fijas(features)
    return F.struct(F.array(*_entradas(fijas)).alias("x") if fijas else F.array().cast("array<double>").alias("x"),
                    F.coalesce(F.col(yhat).cast("double"), F.lit(0.0)).alias("yhat"))


def _de_historia(h: np.ndarray) -> dict[str, np.ndarray]:
    """Lag and rolling inputs out of the last eight values, NaN where there are fewer."""
    return {"lag_1": h[:, -1], "lag_2": h[:, -2], "lag_4": h[:, -4],
            "rolling_4": h[:, -4:].mean(axis=1), "rolling_8": h.mean(axis=1)}


def _pasos(features: Sequence[str], horizonte: int):
    """Predicts step after step, each prediction the newest value of the history of the next."""
    fijas = _fijas(features)

    def correr(de: pa.Table, e: Ensamble, _: int) -> list:
        escala = de.column("escala").to_numpy().astype(float)
        h = matriz(de.column("_hist"), 8)
        salida = np.empty((len(escala), horizonte))
        pasos = [de.column(f"_f{k}").combine_chunks() for k in range(1, horizonte + 1)]
        for k, paso in enumerate(pasos):
            x = dict(zip(fijas, matriz(paso.field("x"), len(fijas)).T)) if fijas else {}
            # Levels on the product's scale; without enough history the input is 0.
            x |= {c: np.nan_to_num(v / escala) for c, v in _de_historia(h).items()}
            corr = e.predecir(np.column_stack([x[c] for c in features])) * escala
            salida[:, k] = np.maximum(0.0, paso.field("yhat").to_numpy(zero_copy_only=False) + corr)
            h = np.column_stack([h[:, 1:], salida[:, k]])
        return [pa.array(list(salida), pa.list_(pa.float64()))]

    return correr


def ts_wf_multi(filas: DataFrame, prueba: dict | None = None, horizonte: int = 4, reajuste: int = 1,
                features: Sequence[str] = FEATURES, nodos: DataFrame | None = None) -> DataFrame:
    """Multi-step back-test: from every origin in the test part predict h = 1..H, feeding
    predictions back as lags; one row per product, origin and step.

    The rows of the H steps come from window leads, the last eight actuals from a window frame:
    no join. All windows run over one product's weeks. Origins meet the nodes of their fit once, for
    all steps. ``nodos`` are those of ``ajustes_wf``, fitted here if not given.
    """
    w = Window.partitionBy("producto").orderBy("ds")
    base = cortar(con_prueba(filas, prueba))
    d = base.withColumns({
        "_hist": F.collect_list(F.col("y").cast("double")).over(w.rowsBetween(-8, -1)),
        **{f"_f{h}": F.lead(_fila(features), h - 1).over(w) for h in range(1, horizonte + 1)},
        "_reales": F.array(*[F.struct(F.lead("ds", h - 1).over(w).alias("ds"), F.lead("y", h - 1).over(w).alias("real"))
                             for h in range(1, horizonte + 1)]),
    }).select("producto", "ds", "i", "n", "corte", "escala", "prueba", "_hist", "_reales",
              *[f"_f{h}" for h in range(1, horizonte + 1)])
    d, n = _tramos(d.filter((F.col("i") > F.col("corte")) & (F.col("i") <= F.col("n") - horizonte + 1)), reajuste)
    if nodos is None:
        nodos = ajustes_wf(filas, [prueba], reajuste, features, {(prueba["prueba"], t) for t in range(n)})
    d = d.withColumn("ajuste", _ajuste(F.col("tramo"))).drop("i", "n", "corte", "prueba", "tramo")
    dichas = con_nodos(d, nodos, _pasos(features, horizonte), "_p array<double>")
    return dichas.select("producto", F.col("ds").alias("origen"), F.posexplode(F.arrays_zip("_reales", "_p"))).select(
        "producto", "origen", (F.col("pos") + 1).alias("h"), "col._reales.ds", "col._reales.real",
        F.col("col._p").alias("prediccion"))


def cuantiles_h(multi: DataFrame) -> DataFrame:
    """80th percentile of absolute errors of active weeks by product and step, null below three."""
    e = F.when(F.col("real") > 0, F.abs(F.col("real") - F.col("prediccion")))
    return multi.groupBy("producto", F.col("h").alias("semana_offset")).agg(
        percentil80(e).alias("p80"))


def ts_horizonte(historia: DataFrame, futuras: DataFrame, nodos: DataFrame, horizonte: int = 4,
                 features: Sequence[str] = FEATURES, prueba: dict | None = None) -> DataFrame:
    """Recursive forecast of the next H weeks of every product.

    ``historia`` (producto, ds, y, escala, and the product's trial as prueba unless it is given) gives
    the last eight values; ``futuras`` holds H rows per product with calendar and baseline inputs. Both
    are grouped by product: eight and H values. ``nodos`` hold the fits over all rows (see ``ajustes_wf``).
    """
    u = Window.partitionBy("producto").orderBy(F.col("ds").desc())
    hist = (con_prueba(historia, prueba).withColumn("_k", F.row_number().over(u)).filter(F.col("_k") <= 8)
            .groupBy("producto").agg(
                F.transform(F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))), lambda s: s["y"])
                .alias("_hist"),
                F.first("escala").cast("double").alias("escala"), F.first("prueba").alias("prueba")))
    paso = F.row_number().over(Window.partitionBy("producto").orderBy("ds"))
    con_escala = futuras.drop("escala").join(hist.select("producto", "escala"), "producto")
    fila = F.struct(_fila(features).alias("f"), "ds", F.col("yhat"))
    fut = con_escala.withColumn("_h", paso).groupBy("producto").agg(*[
        F.max_by(fila, F.when(F.col("_h") == h, F.col("ds"))).alias(f"_s{h}") for h in range(1, horizonte + 1)])
    x = hist.join(fut, "producto").withColumns({
        "ajuste": _ajuste(F.lit(-1)), **{f"_f{h}": F.col(f"_s{h}.f") for h in range(1, horizonte + 1)},
        "_semanas": F.array(*[F.struct(F.col(f"_s{h}.ds").alias("fecha"), F.col(f"_s{h}.yhat").alias("prophet_solo"))
                              for h in range(1, horizonte + 1)]),
    }).drop("prueba", *[f"_s{h}" for h in range(1, horizonte + 1)])
    x = x.filter(" AND ".join(f"_f{h} IS NOT NULL" for h in range(1, horizonte + 1)))
    dichas = con_nodos(x, nodos, _pasos(features, horizonte), "_p array<double>")
    return dichas.select("producto", F.posexplode(F.arrays_zip("_semanas", "_p"))).select(
        "producto", (F.col("pos") + 1).alias("semana_offset"), "col._semanas.fecha", F.col("col._p").alias("prediccion"),
        "col._semanas.prophet_solo")


def met_importancia(nodos: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Importance of every input that some split uses, largest first: the mean gain of its splits,
    beside their number, total gain and share. A split's gain is by how much it lowers the
    squared error of its node's rows."""
    nombre = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("rasgo") + 1)
    ganancia = F.col("n") * F.col("ganancia")
    d = nodos.filter("rasgo >= 0").groupBy(nombre.alias("feature")).agg(
        F.avg(ganancia).alias("importancia"), F.count(F.lit(1)).alias("usos"), F.sum(ganancia).alias("total"))
    todo = Window.partitionBy(F.lit(1))
    return d.withColumn("parte", F.col("total") / F.sum("total").over(todo)).orderBy(F.col("importancia").desc(), "feature")
