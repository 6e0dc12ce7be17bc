"""Writers of the marts, the ledger and the run metadata.

Marts and ledger change from one whole state to the next: files go to a folder of their own, and one
rename puts a version in place that names it (see ``sinks.versiones``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa import esquemas
from despensa.sinks import versiones as v
from despensa.sources.marts import libro_de
from despensa.streaming import claves as k

COMPACTO = "l-compacto"


def _entrega() -> str:
    return f"entrega={uuid.uuid4().hex}"


def snk_marts(marts: dict[str, DataFrame], carpeta: str) -> None:
    """Replaces the marts, all four at once. The history is written in product order, so a product's
    rows are found by the file statistics; a folder for each product would grow with the catalogue."""
    spark = next(iter(marts.values())).sparkSession
    entrega = _entrega()
    for nombre, esquema in esquemas.MARTS.items():
        tipos = [c.split() for c in esquema.split(", ")]
        df = marts[nombre].select(*[F.col(c).cast(t).alias(c) for c, t in tipos])
        if nombre == "historial_walkforward":
            df = df.orderBy("producto", "ds")
        df.write.parquet(f"{carpeta}/{entrega}/{nombre}")
    v.cambiar(spark, carpeta, lambda _: {"marts": {"carpeta": entrega}})


def _escribir(filas: DataFrame, carpeta: str, id: str) -> dict:
    """Writes rows that have ``mes`` and ``lote``, and the index of their invoice numbers, as a part
    that no version names yet. Rows are gathered by month with sizes evened out at run time: small
    months share a task, a month that holds most of the rows is written by several."""
    entrega = _entrega()
    filas.hint("rebalance", "mes").write.partitionBy("mes", "lote").parquet(f"{carpeta}/{entrega}")
    parte = {"carpeta": entrega, "id": id if id in filas.columns else None}
    if parte["id"]:
        escritas = filas.sparkSession.read.parquet(f"{carpeta}/{entrega}")
        parte |= k.escribir(escritas, id, f"{carpeta}/{v.INDICE}/{entrega}")
    return parte


def entregar(nuevo: DataFrame, carpeta: str, lote: str, fecha: str = "Fecha", id: str = "Consecutivo") -> dict:
    """Stores the rows of a batch as a part of the ledger that is not in it yet."""
    filas = nuevo.withColumns({"mes": F.date_format(fecha, "yyyy-MM"), "lote": F.lit(lote)})
    return _escribir(filas, carpeta, id)


def sin_anteriores(spark: SparkSession, carpeta: str) -> None:
    """Rows that lie beside the versions would vanish with the first one."""
    if v.carpetas(spark, carpeta):
        raise ValueError(f"{carpeta} is a plain table; copy it with compactar to another folder first")


def cubiertos(partes: dict[str, dict]) -> set[str]:
    """Batches whose rows were taken up by a compaction."""
    return {x for p in partes.values() for x in p.get("cubre", [])}


def snk_append(nuevo: DataFrame, carpeta: str, fecha: str = "Fecha", lote: str | None = None) -> str:
    """Adds rows to the ledger, laid out by month and batch; gives the batch's name.

    Without a name the batch gets one of its own, so nothing stored is ever replaced. A named batch
    that is run again replaces its own rows, all at once, so a retried batch leaves no doubles;
    writers that name batches must not share names (see ``streaming.ingest``). A batch that was compacted
    can't be replaced any more.
    """
    spark = nuevo.sparkSession
    lote = f"l-{lote or uuid.uuid4().hex}"
    sin_anteriores(spark, carpeta)
    if lote in cubiertos(v.leer(spark, carpeta)[1]):
        raise ValueError(f"batch {lote} of {carpeta} was compacted and cannot be replaced")
    parte = entregar(nuevo, carpeta, lote, fecha)
    v.cambiar(spark, carpeta, lambda partes: {**partes, lote: parte})
    return lote


def compactar(spark: SparkSession, carpeta: str, destino: str | None = None) -> None:
    """One batch per month instead of many, so that folders and files do not grow with the number of
    appends. In place, batches added meanwhile stay beside it and a batch replaced meanwhile makes
    it start over; old files stay until ``versiones.limpiar``. With ``destino`` the ledger (a plain
    table, too) is copied there and the old folder stays."""
    for _ in range(v.INTENTOS):
        leida, partes = v.leer(spark, carpeta)
        todo = libro_de(spark, carpeta, partes) if partes else spark.read.parquet(carpeta)
        id = next((p["id"] for p in partes.values() if p["id"]), "Consecutivo")
        nueva = _escribir(todo.withColumn("lote", F.lit(COMPACTO)), destino or carpeta, id)
        nueva["cubre"] = sorted((set(partes) | cubiertos(partes)) - {COMPACTO})
        if destino:
            v.cambiar(spark, destino, lambda _: {COMPACTO: nueva})
            return

        def cambio(ahora: dict) -> dict:
            if any(ahora.get(x) != p for x, p in partes.items()):
                raise v.Conflicto(f"{carpeta}: a compacted batch was replaced")
            return {COMPACTO: nueva} | {x: p for x, p in ahora.items() if x not in partes}

        try:
            v.cambiar(spark, carpeta, cambio)
            return
        except v.Conflicto:
            continue
    raise v.Conflicto(f"{carpeta}: batches are replaced faster than they can be compacted")


def snk_meta(spark: SparkSession, carpeta: str, n_productos: DataFrame, momento: str) -> None:
    """One row: run time and number of products."""
    n_productos.select(F.lit(momento).alias("ultima_actualizacion"),
                       F.col(n_productos.columns[0]).cast("bigint").alias("n_productos")) \
        .coalesce(1).write.mode("overwrite").json(f"{carpeta}/metadata")
