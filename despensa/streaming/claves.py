"""Index of the invoice numbers a ledger holds: which of a batch's are stored, read in small parts.

Every write of the ledger stores its invoice numbers by hash bucket, and beside them a filter: a
bitmap for every cell of about two thousand numbers. A batch first looks its numbers up in the
filters of its buckets; only the few it may hold are looked for in the numbers themselves, in their buckets.
A batch of new invoices reads filters and next to no number, whatever the size of the
ledger. Number and length of the invoice numbers don't matter: buckets go by hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Numbers of a cell, whose bitmap has 32,768 bits; of a bucket, at most so many buckets.
CELDA, CUBO, CUBOS = 2048, 1_000_000, 4096
BITS = 32_768
ESQUEMA_CLAVES = "clave string, celda bigint, cubo int"
ESQUEMA_FILTROS = "celda bigint, bits binary, cubo int"


def _potencia(n: float, maximo: int = 1 << 40) -> int:
    """The power of two that is not below ``n``, between 1 and ``maximo``."""
    return min(maximo, 1 << max(0, int(-(-n // 1)) - 1).bit_length())


def _hash(clave: Column | str) -> Column:
    return F.xxhash64(clave)


def _sitios(h: Column) -> list[Column]:
    """Two bits of a cell, from parts of the hash that choose neither cell nor bucket."""
    otro = F.xxhash64(h, F.lit(7))
    return [F.pmod(otro, F.lit(BITS)), F.pmod(F.shiftrightunsigned(otro, 32), F.lit(BITS))]


def escribir(filas: DataFrame, id: str, carpeta: str) -> dict:
    """Stores the numbers and filters of a write; gives what a reader has to know of them."""
    claves = filas.select(F.col(id).cast("string").alias("clave")).filter("clave IS NOT NULL").distinct()
    n = claves.count()
    cubos, celdas = _potencia(n / CUBO, CUBOS), _potencia(n / CELDA)
    celdas = max(celdas, cubos)
    h = _hash("clave")
    d = claves.withColumns({"celda": F.pmod(h, F.lit(celdas)), "cubo": F.pmod(h, F.lit(cubos)).cast("int")})
    # Cells follow each other inside a file, so a reader skips the row groups of others.
    d.repartition(F.col("cubo")).sortWithinPartitions("cubo", "celda").write.partitionBy("cubo").parquet(f"{carpeta}/claves")
    spark = filas.sparkSession
    guardadas = spark.read.schema(ESQUEMA_CLAVES).parquet(f"{carpeta}/claves")
    (guardadas.select("cubo", "celda", F.explode(F.array(*_sitios(_hash("clave")))).alias("sitio"))
     .groupBy("cubo", "celda").agg(F.bitmap_construct_agg("sitio").alias("bits"))
     .select("celda", "bits", "cubo").repartition(F.col("cubo")).sortWithinPartitions("cubo", "celda")
     .write.partitionBy("cubo").parquet(f"{carpeta}/filtros"))
    return {"claves": n, "cubos": cubos, "celdas": celdas}


def _de(spark: SparkSession, carpetas: list[str], tabla: str, esquema: str) -> DataFrame:
    """One part of the index of several writes with the same number of buckets."""
    return reduce(DataFrame.unionByName, [
        spark.read.schema(esquema).parquet(f"{c}/{tabla}") for c in carpetas])


def _grupos(partes: list[dict]) -> dict[tuple[int, int], list[str]]:
    """Folders by their numbers of buckets and cells, powers of two: a few dozen groups at most."""
    g: dict[tuple[int, int], list[str]] = {}
    for p in partes:
        if p.get("claves"):
            g.setdefault((p["cubos"], p["celdas"]), []).append(p["ruta"])
    return g


def _cubos(claves: DataFrame, cubos: int) -> list[int]:
    """Buckets the numbers fall into: at most CUBOS of them."""
    if cubos == 1:
        return [0]
    return sorted(r[0] for r in claves.select(
        F.pmod(_hash("clave"), F.lit(cubos)).cast("int").alias("c")).distinct().collect())


def _bit(bits: Column, sitio: Column) -> Column:
    octeto = F.conv(F.hex(F.substring(bits, (F.floor(sitio / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", octeto, F.pmod(sitio, F.lit(8)).cast("int")).bitwiseAND(1) == 1


def posibles(claves: DataFrame, partes: list[dict]) -> DataFrame | None:
    """Which of the numbers (column clave) some filter may hold, with the write's bucket count."""
    spark, salida = claves.sparkSession, []
    for (cubos, celdas), rutas in _grupos(partes).items():
        h = _hash("clave")
        buscadas = claves.select("clave", F.pmod(h, F.lit(celdas)).alias("celda"), F.pmod(h, F.lit(cubos)).cast("int").alias("cubo"),
                                 *[s.alias(f"s{i}") for i, s in enumerate(_sitios(h))])
        filtros = _de(spark, rutas, "filtros", ESQUEMA_FILTROS).filter(F.col("cubo").isin(_cubos(claves, cubos)))
        salida.append(filtros.join(buscadas, ["cubo", "celda"]).filter(
            _bit(F.col("bits"), F.col("s0")) & _bit(F.col("bits"), F.col("s1"))).select("clave").distinct())
    return reduce(DataFrame.unionByName, salida).distinct() if salida else None


def buscar(claves: DataFrame, partes: list[dict]) -> DataFrame | None:
    """Which of the numbers the writes hold. ``claves`` should be a stored table: small or large, it is
    read for every group of writes."""
    spark, salida = claves.sparkSession, []
    for (cubos, _), rutas in _grupos(partes).items():
        lista = _cubos(claves, cubos)
        if lista:
            guardadas = _de(spark, rutas, "claves", ESQUEMA_CLAVES).filter(F.col("cubo").isin(lista))
            salida.append(guardadas.join(claves.select("clave"), "clave", "left_semi").select("clave").distinct())
    return reduce(DataFrame.unionByName, salida).distinct() if salida else None
