"""Fitted ensembles as one table of nodes, and predictions by walking it.

A row is a node of a tree of a fit: its input and threshold, its children, its value, the tree's weight.
Rows to predict meet the nodes of the fit they name; all trees are walked together, a level at a
time. The plan is the same for one fit or for thousands, and no model stays on the driver.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from despensa.soporte import cortar, enviar_por_valor, ruta_nueva

enviar_por_valor(__name__)

NODOS = ["ajuste", "arbol", "nodo", "rasgo", "umbral", "izquierda", "derecha", "valor", "peso", "n", "ganancia"]
# Rows of one group, row-tree pairs walked at a time, fits at a time: bounds on tasks and driver.
FILAS, PARES, A_LA_VEZ = 50_000, 2_000_000, 16


def ajustar_todos(spark: SparkSession, tareas: Sequence[tuple[int, Callable[[], GBTRegressionModel]]],
                  a_la_vez: int | None = None) -> DataFrame:
    """Nodes of independent fits, which run side by side as in a cross-validator: a single boosting
    is a chain of small jobs that leaves most of the cluster idle. A task is the number of its fit and a
    function that fits; the model is written as soon as it is there. As many at a time as the
    driver has cores, for each keeps a thread and a model there."""
    base = ruta_nueva(spark, "arboles")

    def uno(tarea: tuple[int, Callable[[], GBTRegressionModel]]) -> None:
        numero, ajustar = tarea
        ajustar().write().save(f"{base}/ajuste={numero}")

    a_la_vez = min(a_la_vez or min(os.cpu_count() or 1, A_LA_VEZ), len(tareas))
    if a_la_vez < 2:
        for t in tareas:
            uno(t)
    else:
        with ThreadPool(a_la_vez) as pool:
            pool.map(lambda t: inheritable_thread_target(spark)(uno)(t), tareas, chunksize=1)
    return leer_nodos(spark, base)


def nodos_de(modelo: GBTRegressionModel, spark: SparkSession, ajuste: int = 0) -> DataFrame:
    return ajustar_todos(spark, [(ajuste, lambda: modelo)])


def leer_nodos(spark: SparkSession, base: str) -> DataFrame:
    """Nodes of all ensembles written below ``base``; a leaf's input is -1."""
    def parte(nombre: str) -> DataFrame:
        return spark.read.option("basePath", base).parquet(f"{base}/ajuste=*/{nombre}").withColumn(
            "ajuste", F.col("ajuste").cast("bigint"))

    d, pesos = parte("data"), parte("treesMetadata")
    pesos = pesos.select("ajuste", F.col("_1").alias("treeID"), F.col("_3").alias("peso"))
    nodo = F.col("nodeData")
    return cortar(d.join(pesos, ["ajuste", "treeID"]).select(
        "ajuste", F.col("treeID").alias("arbol"), nodo["id"].alias("nodo"), nodo["split"]["featureIndex"].alias("rasgo"),
        F.get(nodo["split"]["leftCategoriesOrThreshold"], 0).alias("umbral"), nodo["leftChild"].alias("izquierda"),
        nodo["rightChild"].alias("derecha"), nodo["prediction"].alias("valor"), "peso",
        nodo["rawCount"].alias("n"), nodo["gain"].alias("ganancia")))


def encoger(nodos: DataFrame, regular: dict[int, tuple[float, float]]) -> DataFrame:
    """Leaf values with L1 and L2 weights: the sum of the leaf's residuals, brought ``alfa`` nearer to 0, over
    its count plus ``lambda``. ``regular`` names both for each fit.

    That is the weight a regularised boosting gives the leaf of its first tree. Later trees were fitted to
    residuals of unshrunk ones, so there it is a damping after the fact.
    """
    tabla = nodos.sparkSession.createDataFrame(
        [(k, float(a), float(x)) for k, (a, x) in regular.items()], "ajuste bigint, _alfa double, _lambda double")
    suma = F.col("valor") * F.col("n")
    nuevo = F.signum(suma) * F.greatest(F.abs(suma) - F.col("_alfa"), F.lit(0.0)) / (F.col("n") + F.col("_lambda"))
    return nodos.join(F.broadcast(tabla), "ajuste").withColumn(
        "valor", F.when(F.col("rasgo") < 0, nuevo).otherwise(F.col("valor"))).select(*NODOS)


class Ensamble:
    """The trees of one fit as arrays of a row per tree."""

    def __init__(self, nodos: pa.Table):
        c = {n: nodos.column(n).to_numpy() for n in ("arbol", "nodo", "rasgo", "umbral", "izquierda", "derecha", "valor", "peso")}
        arboles, orden = np.unique(c["arbol"], return_inverse=True)
        forma = (len(arboles), int(c["nodo"].max()) + 1)
        self.rasgo = np.full(forma, -1, np.int32)
        self.umbral, self.valor = np.zeros(forma), np.zeros(forma)
        self.hijos = np.zeros((*forma, 2), np.int32)
        lugar = (orden, c["nodo"])
        self.rasgo[lugar], self.valor[lugar] = c["rasgo"], c["valor"]
        self.umbral[lugar] = np.nan_to_num(c["umbral"].astype(float))
        self.hijos[(*lugar, 0)], self.hijos[(*lugar, 1)] = c["izquierda"], c["derecha"]
        self.peso = np.zeros(len(arboles))
        self.peso[orden] = c["peso"]

    def _bloque(self, x: np.ndarray) -> np.ndarray:
        arbol = np.arange(len(self.peso))[None, :]
        nodo = np.zeros((len(x), len(self.peso)), np.int32)
        while True:
            rasgo = self.rasgo[arbol, nodo]
            if (rasgo < 0).all():
                return self.valor[arbol, nodo] * self.peso
            derecha = np.take_along_axis(x, np.maximum(rasgo, 0), 1) > self.umbral[arbol, nodo]
            nodo = np.where(rasgo < 0, nodo, self.hijos[arbol, nodo, derecha.astype(np.int8)])

    def partes(self, x: np.ndarray) -> np.ndarray:
        """What every tree adds to each row, trees in the order they were fitted."""
        paso = max(1, PARES // len(self.peso))
        return np.concatenate([self._bloque(x[i:i + paso]) for i in range(0, len(x), paso)] or [np.zeros((0, len(self.peso)))])

    def predecir(self, x: np.ndarray) -> np.ndarray:
        return self.partes(x).sum(axis=1)

    def hasta(self, x: np.ndarray, cuentas: Sequence[int]) -> np.ndarray:
        """Predictions of the first trees alone, for each of these counts: one walk scores them all."""
        sumas = np.cumsum(self.partes(x), axis=1)
        return sumas[:, [min(c, sumas.shape[1]) - 1 for c in cuentas]]


def matriz(columna: pa.ChunkedArray, ancho: int | None = None) -> np.ndarray:
    """A column of arrays as a matrix; shorter arrays stand at the right, with NaN before them."""
    c = columna.combine_chunks() if isinstance(columna, pa.ChunkedArray) else columna
    largo = np.asarray(pa.compute.list_value_length(c), int)
    ancho = ancho or (int(largo[0]) if len(largo) else 0)
    plano = np.asarray(pa.compute.list_flatten(c).to_numpy(zero_copy_only=False), float)
    if (largo == ancho).all():
        return plano.reshape(len(largo), ancho)
    m = np.full((len(largo), ancho), np.nan)
    m[np.arange(ancho)[None, :] >= ancho - largo[:, None]] = plano
    return m


def con_nodos(filas: DataFrame, nodos: DataFrame, f: Callable[[pa.Table, Ensamble, int], list], nuevas: str) -> DataFrame:
    """``filas`` with the columns ``nuevas`` that ``f(rows, ensemble, fit)`` gives, where ``ajuste`` names the
    fit of a row. Rows of one fit are dealt over as many groups as keep to FILAS, each beside the nodes."""
    filas = cortar(filas)
    mayor = filas.groupBy("ajuste").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    grupos = -(-mayor // FILAS) or 1
    resto = [c for c in filas.columns if c != "ajuste"]
    esquema = T.StructType([*[filas.schema[c] for c in resto], *T._parse_datatype_string(nuevas)])
    nombres = [c.name for c in T._parse_datatype_string(nuevas)]
    tipos = [to_arrow_type(c.dataType) for c in T._parse_datatype_string(nuevas)]

    def unir(clave: tuple, de: pa.Table, arboles: pa.Table) -> pa.Table:
        if not len(de):
            return pa.table([*[de.column(c) for c in resto], *[pa.array([], t) for t in tipos]], names=[*resto, *nombres])
        columnas = f(de, Ensamble(arboles), int(clave[0].as_py()))
        return pa.table([*[de.column(c) for c in resto], *columnas], names=[*resto, *nombres])

    reparto = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in resto[:2]]), F.lit(grupos))
    return (
        filas.withColumn("_grupo", reparto).groupBy("ajuste", "_grupo")
        .cogroup(nodos.withColumn("_grupo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grupos - 1).cast("bigint"))))
                 .groupBy("ajuste", "_grupo"))
        .applyInArrow(unir, esquema)
    )
