"""Spark session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the sizing at run time: it merges small shuffle partitions, splits the
# skewed ones of a join and turns a join into a broadcast one once the measured side is small.
AJUSTES = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Files of a cut go when the frame that holds it goes.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call-site capture costs several milliseconds for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def crear_sesion(maestro: str | None = None, nombre: str = "despensa", **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(nombre)
    if maestro:
        b = b.master(maestro)
    for clave, valor in AJUSTES.items():
        b = b.config(clave, valor)
    for clave, valor in extra.items():
        b = b.config(clave.replace("__", "."), valor)
    return b.getOrCreate()
