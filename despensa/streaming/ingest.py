"""Incremental invoice ingest, in batch and as a stream, with one transform for both.

An invoice is taken once: lines of an invoice already stored are dropped, lines of a new invoice
are all kept. Dropping duplicate ids instead would lose lines. Pages that cannot be read go to a
table of rejects beside the ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from despensa import esquemas
from despensa.sinks import versiones as v
from despensa.sinks.marts import entregar, sin_anteriores
from despensa.soporte import guardar_en, ruta_nueva
from despensa.sources.invoices import LECTURA, lineas_de_facturas, normalizar, paginas_malas
from despensa.sources.marts import src_libro as guardado  # noqa: F401  the ledger as readers see it
from despensa.streaming import claves as k

ID = "Consecutivo"


def rechazos(carpeta: str) -> str:
    """Where the rejects of a ledger are."""
    return f"{carpeta.rstrip('/')}-rechazos"


def _vistas(claves: DataFrame, carpeta: str, partes: dict[str, dict], temporal: str) -> DataFrame | None:
    """Invoice numbers of the batch that the parts hold, None if there are none.

    The filters of the index are read first, in the buckets the batch's numbers fall into; the numbers
    themselves only in the buckets of those that pass.
    """
    indice = [p | {"ruta": f"{carpeta}/{v.INDICE}/{p['carpeta']}"} for p in partes.values()]
    quiza = k.posibles(claves, indice)
    if quiza is None:
        return None
    quiza = guardar_en(quiza, temporal)
    return None if quiza.isEmpty() else k.buscar(quiza, indice)


def ingerir(paginas: DataFrame, carpeta: str, lote: str) -> int:
    """Adds the new invoices of a set of pages to the ledger; gives the number of rows added.

    Rows of the same batch do not count as stored: a batch run again replaces its own rows, unless they
    were compacted, which makes them stored ones. The pages are parsed once. What is stored already is
    found through the index of the invoice numbers, so neither the ledger nor its index is read as
    a whole. The rows come into the ledger in one step; if another writer was first, the batch is looked
    up again in what that one added, so no invoice is taken twice. Pages that cannot be taken are
    kept, by batch, in the rejects.
    """
    spark = paginas.sparkSession
    base = ruta_nueva(spark, "ingesta")
    try:
        return _ingerir(paginas, carpeta, f"l-{lote}", base)
    finally:
        v.borrar(spark, base)


def _ingerir(paginas: DataFrame, carpeta: str, lote: str, base: str) -> int:
    spark = paginas.sparkSession
    sin_anteriores(spark, carpeta)
    paginas = guardar_en(paginas, f"{base}/paginas")
    malas = paginas_malas(paginas).withColumn("lote", F.lit(lote))
    (malas.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("lote").parquet(rechazos(carpeta)))
    lineas = guardar_en(normalizar(lineas_de_facturas(paginas)), f"{base}/lineas")
    claves = guardar_en(lineas.select(F.col(ID).alias("clave")).distinct(), f"{base}/claves")
    for intento in range(v.INTENTOS):
        leida, partes = v.leer(spark, carpeta)
        otras = {x: p for x, p in partes.items() if x != lote}
        vistas = _vistas(claves, carpeta, otras, f"{base}/quiza-{intento}")
        nuevas = lineas if vistas is None else guardar_en(
            lineas.join(vistas.withColumnRenamed("clave", ID), ID, "left_anti"), f"{base}/nuevas-{intento}")
        n = nuevas.count()
        if not n and lote not in partes:
            return 0
        despues = otras | ({lote: entregar(nuevas, carpeta, lote, id=ID)} if n else {})
        try:
            v.confirmar(spark, carpeta, leida, despues)
            return n
        except v.Conflicto:
            continue
    raise v.Conflicto(f"{carpeta}: other writers were first {v.INTENTOS} times")


def stm_ingesta(spark: SparkSession, entrada: str, carpeta: str, control: str,
                archivos: int | None = None, paginas: bool = False) -> StreamingQuery:
    """Stream form: every landed page file is handed to ``ingerir`` once, in micro-batches.

    The stream's own id, kept in its control folder, and the batch number name the rows a batch
    writes: a batch replayed after a failure is idempotent, and another stream, or one whose
    control folder was reset, never writes over them. ``paginas`` as in the batch form.
    """
    lector = spark.readStream.schema(esquemas.FACTURAS_JSON).options(**LECTURA).option(
        "multiLine", paginas)
    if archivos:
        lector = lector.option("maxFilesPerTrigger", archivos)

    def lote(df: DataFrame, epoca: int) -> None:
        flujo = spark.read.json(f"{control}/metadata").first()["id"]
        ingerir(df, carpeta, f"{flujo}-{epoca}")

    return (lector.json(entrada).writeStream.foreachBatch(lote)
            .option("checkpointLocation", control).trigger(availableNow=True).start())
