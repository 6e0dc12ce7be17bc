"""Recipes: sheets to lines, sale names to dishes, forecasts to ingredients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from despensa.functions.text import cln_acentos, cln_variantes, cln_venta
from despensa.operators.filters import flt_encabezado
from despensa.operators.ordered import win_ffill
from despensa.soporte import cortar


def _lleno(c: str) -> Column:
    """Trimmed text, null when blank or the word a spreadsheet writes for an empty cell."""
    s = F.trim(F.col(c))
    return F.when(~s.isin("", "nan"), s)


def recetas_de_hojas(hojas: DataFrame) -> DataFrame:
    """Sheet rows (hoja, fila, porcion, receta, ingrediente, cantidad, unidad) to recipe lines.

    A row with a dish starts it, with its portion, even an empty one; the rows below belong to it.
    """
    d = flt_encabezado(hojas, "receta")
    cabeza = F.when(_lleno("receta").isNotNull(),
                    F.struct(_lleno("receta").alias("plato"), F.trim("porcion").alias("porcion")))
    d = win_ffill(d, cabeza, "_p", ["hoja"], "fila")
    return d.filter(F.col("_p").isNotNull() & _lleno("ingrediente").isNotNull()).select(
        F.col("hoja").alias("categoria"), F.col("_p.plato").alias("plato"),
        F.col("_p.porcion").alias("porcion"), _lleno("ingrediente").alias("ingrediente"),
        "cantidad", F.coalesce(F.trim("unidad"), F.lit("")).alias("unidad"),
        F.struct("hoja", "fila").alias("orden"))


# Characters of a gram. Texts shorter than that are found by their own exact list.
GRAMA = 3


def _trozos(c: Column, desde: int, hasta: int) -> Column:
    """Distinct substrings of ``desde`` to ``hasta`` characters: as many as the text is long for each length."""
    n = F.length(c)

    def de(k: int) -> Column:
        trozos = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(c, i, F.lit(k)))
        return F.when(n >= k, trozos).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[de(k) for k in range(desde, hasta + 1)])))


def _dentro(patrones: DataFrame, textos: DataFrame) -> DataFrame:
    """(texto, patron) for every pattern of at least GRAMA characters inside a text; both sides distinct.

    The grams of the texts are an index. A pattern is looked up by the gram of its own that fewest
    texts hold, and only the texts found there are searched. One with a gram that no text holds is nowhere.
    """
    indice = textos.select("texto", F.explode(_trozos(F.col("texto"), GRAMA, GRAMA)).alias("grama"))
    frecuencia = indice.groupBy("grama").agg(F.count(F.lit(1)).alias("n"))
    elegida = (
        patrones.select(F.col("texto").alias("patron"), F.explode(_trozos(F.col("texto"), GRAMA, GRAMA)).alias("grama"))
        .join(frecuencia, "grama", "left")
        .groupBy("patron").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "grama")).alias("m"))
        .filter("m.n > 0").select("patron", "m.grama")
    )
    return indice.join(elegida, "grama").filter(F.contains("texto", "patron")).select("texto", "patron")


def jn_receta(recetas: DataFrame, nombres: DataFrame, nombre: str = "producto",
              orden: str = "orden") -> DataFrame:
    """Best dish of each sale name, null if none: exact on the ordered spellings first, then one
    text inside the other, first spelling and first dish winning.

    Texts of three characters or more are found by the rarest gram of the inner one, shorter ones among
    the substrings of one and two characters: the work is linear in the length of a text. Each text
    keeps only its first dish before pairs meet spellings, so hot words cannot multiply them.
    """
    platos = (
        recetas.filter(F.col("plato").isNotNull())
        .groupBy("plato").agg(F.min(orden).alias("o"))
        .withColumn("texto", cln_acentos("plato")).filter(F.length("texto") > 0)
        .groupBy("texto").agg(F.min(F.struct("o", "plato")).alias("p"))
    )
    platos = cortar(platos)
    variantes = nombres.select(nombre).filter(F.col(nombre).isNotNull()).distinct().select(
        nombre, F.posexplode(cln_variantes(cln_venta(nombre))).alias("pos", "texto")
    ).filter(F.length("texto") > 0)
    variantes = cortar(variantes)
    textos = cortar(variantes.select("texto").distinct())
    corto = F.length("texto") < GRAMA
    mejor_plato = F.min("p").alias("p")
    # First dish inside, or around, each spelling; a spelling has at most one row from each of the four.
    dentro = _dentro(platos.filter(~corto), textos).join(
        platos.withColumnRenamed("texto", "patron"), "patron").groupBy("texto").agg(mejor_plato)
    dentro_cortos = textos.select("texto", F.explode(_trozos(F.col("texto"), 1, GRAMA - 1)).alias("patron")).join(
        platos.filter(corto).withColumnRenamed("texto", "patron"), "patron").groupBy("texto").agg(mejor_plato)
    fuera = _dentro(textos.filter(~corto), platos.select("texto")).join(platos, "texto").groupBy("patron").agg(
        mejor_plato).withColumnRenamed("patron", "texto")
    fuera_cortos = platos.select(F.explode(_trozos(F.col("texto"), 1, GRAMA - 1)).alias("texto"), "p").groupBy("texto").agg(
        mejor_plato).join(textos.filter(corto), "texto", "left_semi")
    contenidos = dentro.unionByName(dentro_cortos).unionByName(fuera).unionByName(fuera_cortos)
    hallados = platos.select("texto", F.lit(1).alias("etapa"), "p").unionByName(
        contenidos.select("texto", F.lit(2).alias("etapa"), "p"))
    mejor = variantes.join(hallados, "texto").groupBy(nombre).agg(F.min(F.struct("etapa", "pos", "p")).alias("m"))
    return (nombres.select(nombre).filter(F.col(nombre).isNotNull()).distinct()
            .join(mejor, nombre, "left").select(nombre, F.col("m.p.plato").alias("plato")))


def jn_explosion(pronostico: DataFrame, mapa: DataFrame, recetas: DataFrame) -> DataFrame:
    """Forecast units to ingredient lines; an amount that is no number counts as 0."""
    return (
        pronostico.join(mapa.filter(F.col("plato").isNotNull()), "producto")
        .join(recetas.select("plato", "ingrediente", "cantidad", "unidad"), "plato")
        .withColumn("cantidad_total", F.coalesce(F.col("cantidad").try_cast("double"), F.lit(0.0))
                    * F.col("prediccion"))
    )


def agg_insumos(explosion: DataFrame, *por: str) -> DataFrame:
    """Amount of each ingredient and unit, largest first."""
    return (explosion.groupBy(*por, "ingrediente", "unidad")
            .agg(F.sum("cantidad_total").alias("cantidad"))
            .orderBy(F.col("cantidad").desc(), "ingrediente", "unidad"))
