"""Readers of the forecast marts, of the stored ledger and of the run metadata."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa import esquemas
from despensa.sinks import versiones as v


def src_marts(spark: SparkSession, carpeta: str) -> dict[str, DataFrame]:
    """The four marts of the newest version, all of the same run; one that was never written is an
    empty table of its schema. A folder without versions is read as it lies."""
    partes = v.leer(spark, carpeta)[1]
    de = f"{carpeta}/{partes['marts']['carpeta']}" if partes else carpeta
    salida = {}
    for nombre, esquema in esquemas.MARTS.items():
        try:
            salida[nombre] = spark.read.schema(esquema).parquet(f"{de}/{nombre}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            salida[nombre] = spark.createDataFrame([], esquema)
    return salida


def libro_de(spark: SparkSession, carpeta: str, partes: dict[str, dict]) -> DataFrame:
    """The rows of some parts of a ledger."""
    rutas = [f"{carpeta}/{p['carpeta']}" for p in partes.values()]
    return spark.read.option("basePath", carpeta).parquet(*rutas).drop("entrega")


def src_libro(spark: SparkSession, carpeta: str) -> DataFrame | None:
    """The stored ledger in its newest version, None before the first append. A ledger that is there
    but cannot be read is an error, for without it invoices would be taken twice. A folder of
    plain files is read as it lies."""
    partes = v.leer(spark, carpeta)[1]
    if partes:
        return libro_de(spark, carpeta, partes)
    return spark.read.parquet(carpeta) if v.carpetas(spark, carpeta) else None


def src_meta(spark: SparkSession, carpeta: str) -> DataFrame:
    """Time of the last run, to the minute, and its number of products."""
    m = spark.read.schema(esquemas.METADATOS).json(f"{carpeta}/metadata")
    return m.withColumn("fecha_modelo", F.replace(F.left("ultima_actualizacion", F.lit(16)),
                                                  F.lit("T"), F.lit(" ")))
