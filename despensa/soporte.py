"""Shared helpers: lineage cuts, distributed ranking and prefix sums, exact percentiles."""

from __future__ import annotations

import math
import re
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Bounds on the number of range buckets a global order is cut into. Only bucket totals, at most
# 512 * 257 short rows, are ever gathered in one place.
CUBETAS = (32, 512)


def enviar_por_valor(modulo: str) -> None:
    """Ships the functions of a module with the job, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[modulo])


enviar_por_valor(__name__)


def carpeta_compartida(spark: SparkSession) -> str:
    """Folder for checkpoints and written tables, as the cluster names it.

    A local session without the setting (tests) gets a temporary folder of its own.
    """
    ruta = spark.conf.get("spark.checkpoint.dir", None)
    if not ruta:
        ruta = spark.sparkContext.getCheckpointDir()
    if not ruta:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        ruta = tempfile.mkdtemp(prefix="despensa-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(ruta)
    return ruta


def ruta_nueva(spark: SparkSession, nombre: str) -> str:
    """A fresh path below the shared folder."""
    return f"{carpeta_compartida(spark)}/{nombre}-{uuid.uuid4().hex}"


def guardar(df: DataFrame, nombre: str) -> DataFrame:
    """Like ``cortar``, as a Parquet table in the shared folder: later reads prune columns and rows."""
    return guardar_en(df, ruta_nueva(df.sparkSession, nombre))


def guardar_en(df: DataFrame, ruta: str) -> DataFrame:
    """``guardar`` at a path the caller removes when the table is used."""
    df.write.parquet(ruta)
    return df.sparkSession.read.schema(df.schema).parquet(ruta)


def cortar(df: DataFrame) -> DataFrame:
    """Run the plan once and go on from the stored result.

    Used where several later steps read the same small table (product totals, model rows), so the
    ledger behind it is scanned a single time. Survives lost executors: the copy is in the shared
    folder.
    """
    carpeta_compartida(df.sparkSession)
    return df.checkpoint()


def _orden(df: DataFrame, metrica: str, nombre: str) -> DataFrame:
    """Adds ``_cubo``, a string bucket whose order agrees with (metrica desc, md5(nombre)).

    The cut points, a few numbers, come from one approximate-percentile pass. A value that fills a
    whole bucket on its own (many products with the same count) is cut further by the hash of the
    name, so no bucket can hold more than a few percent of the rows however the metric is spread.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(max(n, CUBETAS[0]), CUBETAS[1])
    puntos = [i / n for i in range(1, n)]
    m = F.col(metrica).cast("double")
    cortes = df.select(F.percentile_approx(m, puntos, 10000)).first()[0] or []
    lista = F.array(*[F.lit(c) for c in cortes]).cast("array<double>")
    mayores = F.size(F.filter(lista, lambda c: c > m))
    repetidos = [c for c in set(cortes) if cortes.count(c) >= 2]
    return df.withColumn("_md5", F.md5(F.col(nombre).cast("string"))).withColumn(
        "_cubo",
        F.concat(
            F.lpad(mayores.cast("string"), 4, "0"),
            F.when(m.isin(repetidos), F.concat(F.lit("1"), F.substring("_md5", 1, 2)))
            .otherwise("0"),
        ),
    )


def acumular(df: DataFrame, metrica: str, nombre: str, acum: str = "acum", pos: str = "pos",
             total: str = "total") -> DataFrame:
    """Running sum, row number and grand total over (metrica desc, md5(nombre)), distributed.

    Each bucket is summed on its own; the running sum over bucket totals is a table of bounded
    size, broadcast back. Ties fall in the order of the name's md5, a fixed and evenly spread order.
    The input is read three times, so it is stored first.
    """
    b = _orden(cortar(df.filter(F.col(metrica).isNotNull())), metrica, nombre)
    dentro = (
        Window.partitionBy("_cubo").orderBy(F.col(metrica).desc(), "_md5", nombre)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    previos = Window.orderBy("_cubo").rowsBetween(Window.unboundedPreceding, -1)
    todo = Window.partitionBy(F.lit(1))
    bases = (
        b.groupBy("_cubo").agg(F.sum(metrica).alias("_s"), F.count(F.lit(1)).alias("_n"))
        .select(
            "_cubo",
            F.coalesce(F.sum("_s").over(previos), F.lit(0)).alias("_s0"),
            F.coalesce(F.sum("_n").over(previos), F.lit(0)).alias("_n0"),
            F.sum("_s").over(todo).alias("_st"),
        )
    )
    return (
        b.withColumn("_sa", F.sum(metrica).over(dentro))
        .withColumn("_na", F.row_number().over(
            Window.partitionBy("_cubo").orderBy(F.col(metrica).desc(), "_md5", nombre)))
        .join(F.broadcast(bases), "_cubo")
        .withColumn(acum, F.col("_s0") + F.col("_sa"))
        .withColumn(pos, (F.col("_n0") + F.col("_na")).cast("bigint"))
        .withColumn(total, F.col("_st"))
        .drop("_cubo", "_md5", "_sa", "_na", "_s0", "_n0", "_st")
    )


# Digits of a percentile's key and how many passes find all of them: 65,536 counters a pass.
DIGITO, PASADAS = 16, 4


def _clave(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers of the same order."""
    b = np.asarray(x, np.float64).view(np.uint64)
    signo = np.uint64(1 << 63)
    return np.where(b & signo, ~b, b | signo)


def _valor(clave: int) -> float:
    """The double of a key."""
    signo = 1 << 63
    return float(np.array([clave ^ signo if clave & signo else ~clave & (1 << 64) - 1], np.uint64).view(np.float64)[0])


def _contar(df: DataFrame, cols: list[str], prefijos: list[tuple[int, int]], pasada: int) -> dict[int, np.ndarray]:
    """How often each next digit follows a prefix (column, digits so far). A task keeps 65,536 counters a
    prefix and no value; as many short rows reach the driver."""
    baja = np.uint64(64 - DIGITO * (pasada + 1))
    n = 1 << DIGITO

    def tarea(partes):
        cuentas = np.zeros((len(prefijos), n), np.int64)
        for parte in partes:
            for k, (c, prefijo) in enumerate(prefijos):
                col = parte.column(c)
                x = _clave(col.filter(col.is_valid()).to_numpy(zero_copy_only=False)) >> baja
                if pasada:
                    x = x[x >> np.uint64(DIGITO) == np.uint64(prefijo)]
                cuentas[k] += np.bincount((x & np.uint64(n - 1)).astype(np.int64), minlength=n)
        k, digito = np.nonzero(cuentas)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v.astype(np.int64)) for v in (k, digito, cuentas[k, digito])], names=["k", "digito", "n"])

    d = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    t = d.mapInArrow(tarea, "k long, digito long, n long").groupBy("k", "digito").agg(F.sum("n").alias("n")).toArrow()
    salida = {k: np.zeros(n, np.int64) for k in range(len(prefijos))}
    for k, digito, m in zip(*(t.column(c).to_pylist() for c in ("k", "digito", "n"))):
        salida[k][digito] = m
    return salida


def percentiles_exactos(df: DataFrame, cols: list[str], p: float) -> list[float | None]:
    """Exact, linearly interpolated percentile of whole columns.

    The built-in exact percentile keeps every distinct value in one task. Here the wanted ranks are found
    digit by digit: each pass counts the next 16 bits of the values that begin like the one wanted, so
    four passes find it, whatever the values and however often one repeats. No task holds values.
    Reads the columns four times: pass a stored table.
    """
    buscados: dict[tuple[int, int], tuple[int, int]] = {}  # (column, which rank) -> (prefix, rank within it)
    fraccion: dict[int, float] = {}
    for pasada in range(PASADAS):
        lista = sorted({(c, pre) for (c, _), (pre, _) in buscados.items()}) if pasada else [(c, 0) for c in range(len(cols))]
        cuentas = {x: v for x, v in zip(lista, _contar(df, cols, lista, pasada).values())}
        if not pasada:
            for c in range(len(cols)):
                n = int(cuentas[c, 0].sum())
                if n:
                    rango = (n - 1) * p
                    fraccion[c] = rango - math.floor(rango)
                    buscados |= {(c, 0): (0, math.floor(rango)), (c, 1): (0, math.ceil(rango))}
        for x, (prefijo, rango) in buscados.items():
            hasta = np.cumsum(cuentas[x[0], prefijo])
            digito = int(np.searchsorted(hasta, rango, side="right"))
            antes = int(hasta[digito - 1]) if digito else 0
            buscados[x] = (prefijo << DIGITO | digito, rango - antes)

    def de(c: int) -> float | None:
        if c not in fraccion:
            return None
        a, b = (_valor(buscados[c, i][0]) for i in (0, 1))
        return a if a == b else a + (b - a) * fraccion[c]

    return [de(c) for c in range(len(cols))]


def dimension(spark: SparkSession, **columnas: tuple[pa.DataType, list]) -> DataFrame:
    """Small constant table. Given as Arrow it becomes a local relation the optimizer knows the
    size of, not a job over Python rows."""
    return spark.createDataFrame(pa.table(
        {n: pa.array(v, t) for n, (t, v) in columnas.items()}))


def sin_nulos(df: DataFrame, *claves: str) -> DataFrame:
    """Grouping drops null keys, as the ledger rules ask; Spark alone would keep a null group."""
    for c in claves:
        df = df.filter(F.col(c).isNotNull())
    return df


def red(c: Column | str, n: int = 4) -> Column:
    """Report rounding of double results, so that the order of a sum does not show."""
    return F.round(F.col(c) if isinstance(c, str) else c, n)
