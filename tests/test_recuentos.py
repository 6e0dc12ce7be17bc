"""Merged days give the counts of distinct invoices that the ledger gives; long dish names stay cheap."""

import datetime as dt
import random
import time

import pytest
from despensa.operators import recipes as r
from despensa.operators import recuentos as rc
from despensa.soporte import cortar
from pyspark.sql import functions as F

DIA = dt.date(2024, 1, 1)


def ventas(spark, n, semilla):
    g = random.Random(semilla)
    filas = []
    for i in range(n):
        # A third of the lines lie on one day; invoices reach over days; some lines have none.
        dia = DIA + dt.timedelta(days=7 if g.random() < 0.33 else g.randint(0, 40))
        filas.append((dia if g.random() > 0.01 else None, g.choice(["a", "b", None]),
                      None if g.random() < 0.05 else f"F{g.randint(0, n // 3)}", float(g.randint(1, 9)), 1.0))
    return filas, spark.createDataFrame(filas, "Fecha date, Tipo string, Consecutivo string, Total double, Cantidad double")


def directo(filas, desde, hasta, clave):
    out = {}
    for fecha, tipo, factura, total, cantidad in filas:
        if fecha is None and (desde or hasta) or desde and fecha < desde or hasta and fecha > hasta:
            continue
        o = out.setdefault(clave(fecha, tipo), [0.0, 0.0, 0, set()])
        o[0] += total
        o[1] += cantidad
        o[2] += 1
        if factura is not None:
            o[3].add(factura)
    return {k: (i, u, n, len(f)) for k, (i, u, n, f) in out.items()}


def dicho(d):
    return {tuple(r)[:-4] if len(r) > 4 else (): tuple(r)[-4:] for r in d.collect()}


@pytest.mark.parametrize("cubo", [32_768, 64])
def test_cualquier_tramo(spark, monkeypatch, cubo):
    monkeypatch.setattr(rc, "CUBO", cubo)
    filas, v = ventas(spark, 3000, 1)
    dias = cortar(rc.agg_recuento(v, rc.numerar(v), "Tipo"))
    for a, b in ((None, None), (0, 0), (7, 7), (3, 20), (40, 60), (90, 91)):
        desde, hasta = (None if x is None else DIA + dt.timedelta(days=x) for x in (a, b))
        assert dicho(rc.recuento(dias, "Tipo", desde=desde, hasta=hasta)) == directo(filas, desde, hasta, lambda f, t: (t,))
        assert dicho(rc.recuento(dias, desde=desde, hasta=hasta)) == (
            directo(filas, desde, hasta, lambda f, t: ()) or {(): (None, None, None, 0)})
    semana = dicho(rc.recuento(dias, F.weekday("Fecha").alias("n")))
    assert semana == directo(filas, None, None, lambda f, t: (f.weekday() if f else None,))


def test_un_lote_mas(spark):
    """A further batch changes no stored day; an invoice with lines in both batches counts once."""
    filas, v = ventas(spark, 1500, 2)
    mas, w = ventas(spark, 900, 3)
    numeros = cortar(rc.numerar(v))
    dias = cortar(rc.agg_recuento(v, numeros, "Tipo"))
    todos, despues = rc.agg_recuento_nuevo(dias, numeros, w, "Tipo")
    assert dicho(rc.recuento(todos, "Tipo")) == directo(filas + mas, None, None, lambda f, t: (t,))
    n = [x[0] for x in despues.select("numero").collect()]
    assert sorted(n) == list(range(len({f[2] for f in filas + mas} - {None})))


def test_pocos_mapas_por_dia(spark):
    """Numbers follow the first day, so a day of many invoices needs few bitmaps."""
    v = spark.range(200_000).select(
        F.date_add(F.lit(DIA), (F.col("id") % 20).cast("int")).alias("Fecha"), F.col("id").cast("string").alias("Consecutivo"),
        F.lit(1.0).alias("Total"), F.lit(1.0).alias("Cantidad"))
    dias = rc.agg_recuento(v, rc.numerar(v))
    assert dias.filter("cubo IS NOT NULL").count() <= 2 * 20
    assert rc.recuento(dias).first()["Facturas"] == 200_000


def test_facturas_repartidas(spark):
    """Invoices with lines on days all over: what is stored grows with the lines, not by a bitmap a line."""
    n = 60_000
    v = spark.range(n).select(
        F.date_add(F.lit(DIA), (F.col("id") * 7919 % 500).cast("int")).alias("Fecha"),
        (F.col("id") % 20_000).cast("string").alias("Consecutivo"), F.lit(1.0).alias("Total"), F.lit(1.0).alias("Cantidad"))
    dias = cortar(rc.agg_recuento(v, rc.numerar(v)))
    largo = F.length("bits") if dict(dias.dtypes)["bits"] == "binary" else 16 * F.size("bits")
    assert dias.filter("cubo IS NOT NULL").select(F.sum(largo)).first()[0] <= 16 * n
    assert rc.recuento(dias).first()["Facturas"] == 20_000
    un_dia = DIA + dt.timedelta(days=7)
    assert rc.recuento(dias, desde=un_dia, hasta=un_dia).first()["Facturas"] == v.filter(
        F.col("Fecha") == F.lit(un_dia)).select("Consecutivo").distinct().count()


def receta(spark, platos, nombres):
    rec = spark.createDataFrame([(p, i) for i, p in enumerate(platos)], "plato string, orden int")
    nom = spark.createDataFrame([(n,) for n in nombres], "producto string")
    return r.jn_receta(rec, nom)


def test_nombre_largo_es_lineal(spark):
    """Grams of a name of 10,000 characters, not its substrings; names of mixed lengths beside it."""
    g = random.Random(4)
    largo = "".join(g.choice("bcdfg ") for _ in range(10_000))
    d = spark.createDataFrame([(largo,)], "texto string")
    assert d.select(F.size(r._trozos(F.col("texto"), r.GRAMA, r.GRAMA))).first()[0] <= 10_000 - 2
    assert d.select(F.size(r._trozos(F.col("texto"), 1, r.GRAMA - 1))).first()[0] <= 2 * 10_000
    platos = ["sopa", largo[5000:5400].strip(), "zz", *(largo[i:i + 3 + i % 90].strip() + "q" for i in range(0, 9000, 100))]
    t = time.time()
    dicho = {x["producto"]: x["plato"] for x in receta(spark, platos, [largo, "sopa del dia", "nada que ver", "zz top"]).collect()}
    assert dicho[largo] == platos[1] and dicho["sopa del dia"] == "sopa" and time.time() - t < 60


def test_receta_como_bucle(spark):
    """Random short texts, where one is inside the other in every way, against plain loops."""
    from despensa.functions.text import cln_acentos, cln_variantes, cln_venta
    g = random.Random(6)
    texto = lambda k: "".join(g.choice("ab c") for _ in range(g.randint(1, k))).strip() or "a"
    platos, nombres = list(dict.fromkeys(texto(6) for _ in range(25))), list(dict.fromkeys(texto(7) for _ in range(60)))
    limpio = {p: t for p, t in spark.createDataFrame([(p,) for p in platos], "p string").select(
        "p", cln_acentos("p")).collect()}
    formas = {n: list(v) for n, v in spark.createDataFrame([(n,) for n in nombres], "n string").select(
        "n", cln_variantes(cln_venta("n"))).collect()}

    def mejor(n):
        for v in formas[n]:
            for p in platos:
                if v and limpio[p] == v:
                    return p
        for v in formas[n]:
            for p in platos:
                if v and limpio[p] and (limpio[p] in v or v in limpio[p]):
                    return p
        return None

    dicho = {x["producto"]: x["plato"] for x in receta(spark, platos, nombres).collect()}
    # Among dishes of one cleaned text the first stands for all.
    iguales = lambda a, b: a == b or a and b and limpio[a] == limpio[b]
    assert all(iguales(dicho[n], mejor(n)) for n in nombres), [(n, dicho[n], mejor(n)) for n in nombres][:5]
