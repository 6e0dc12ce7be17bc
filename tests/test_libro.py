"""Ledger and marts change in one step; stored invoices are found through their index."""

import datetime as dt
import threading

import pytest
from despensa import esquemas
from despensa.sinks import marts as snk
from despensa.sinks import versiones as v
from despensa.sources import marts as sm
from despensa.streaming import claves as k
from despensa.streaming import ingest
from pyspark.sql import functions as F


def lineas(spark, *numeros, total=1.0):
    return spark.createDataFrame([(str(n), dt.date(2024, 1 + i % 3, 5), total) for i, n in enumerate(numeros)],
                                 "Consecutivo string, Fecha date, Total double")


def paginas(spark, *numeros):
    f = spark.createDataFrame([(str(n),) for n in numeros], "number string")
    return spark.createDataFrame([], esquemas.FACTURAS_JSON).unionByName(f.select(
        F.array(F.struct(F.lit("2024-01-05").alias("date"), "number", F.lit("1").alias("total"))).alias("results")
    ).selectExpr("to_json(struct(results)) AS j").select(
        F.from_json("j", esquemas.FACTURAS_JSON).alias("s")).select("s.*"), allowMissingColumns=True)


def guardadas(spark, libro):
    d = ingest.guardado(spark, libro)
    return sorted(r["Consecutivo"] for r in d.select("Consecutivo").collect()) if d is not None else None


def marts(spark, valor):
    return {n: spark.createDataFrame([], e).unionByName(spark.range(1).select(*[
        F.lit(valor if c.split()[1] in ("double", "bigint", "int") else None).cast(c.split()[1]).alias(c.split()[0])
        for c in e.split(", ")])) for n, e in esquemas.MARTS.items()}


def test_marts_de_una_vez(spark, tmp_path, monkeypatch):
    """A write that dies between the marts leaves all four as they were."""
    ruta = str(tmp_path / "marts")
    with monkeypatch.context() as m:
        m.setattr(v, "confirmar", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            snk.snk_marts(marts(spark, 1), ruta)
    assert all(d.isEmpty() for d in sm.src_marts(spark, ruta).values())
    snk.snk_marts(marts(spark, 1), ruta)
    malos = marts(spark, 2)
    malos["precios_unitarios"] = malos["precios_unitarios"].withColumn(
        "precio_unitario", F.raise_error(F.lit("killed")).cast("double"))
    with pytest.raises(Exception, match="killed"):
        snk.snk_marts(malos, ruta)
    m = sm.src_marts(spark, ruta)
    assert {d.select(F.max("prediccion")).first()[0] for n, d in m.items() if "prediccion" in d.columns} == {1.0}
    snk.snk_marts(marts(spark, 3), ruta)
    assert sm.src_marts(spark, ruta)["predicciones_4_semanas"].first()["prediccion"] == 3.0


def test_append_que_muere(spark, tmp_path, monkeypatch):
    libro = str(tmp_path / "libro")
    snk.snk_append(lineas(spark, 1, 2), libro, lote="a")
    with monkeypatch.context() as m:
        m.setattr(v, "confirmar", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            snk.snk_append(lineas(spark, 3, 4, 5), libro, lote="a")
    assert guardadas(spark, libro) == ["1", "2"]
    snk.snk_append(lineas(spark, 3, 4, 5), libro, lote="a")
    assert guardadas(spark, libro) == ["3", "4", "5"]
    # Two writes are in no version now: the one that died and the one that was replaced. Kept versions
    # name the second, so only the first may go.
    assert v.limpiar(spark, libro, horas=1) == []
    assert len(v.limpiar(spark, libro, horas=-1)) == 1
    assert guardadas(spark, libro) == ["3", "4", "5"]


def test_un_numero_de_version_para_uno(spark, tmp_path):
    ruta = str(tmp_path / "t")
    assert v.leer(spark, ruta) == (0, {})
    assert v.confirmar(spark, ruta, 0, {"a": {"carpeta": "entrega=1"}}) == 1
    with pytest.raises(v.Conflicto):
        v.confirmar(spark, ruta, 0, {"b": {"carpeta": "entrega=2"}})
    assert v.leer(spark, ruta) == (1, {"a": {"carpeta": "entrega=1"}})
    hilos = [threading.Thread(target=lambda i=i: v.cambiar(
        spark, ruta, lambda p: p | {f"h{i}": {"carpeta": f"entrega=h{i}"}})) for i in range(6)]
    for h in hilos:
        h.start()
    for h in hilos:
        h.join()
    n, partes = v.leer(spark, ruta)
    assert n == 7 and set(partes) == {"a", *(f"h{i}" for i in range(6))}


def test_dos_escritores(spark, tmp_path, monkeypatch):
    """While a batch is stored another one takes some of its invoices: it looks again."""
    libro = str(tmp_path / "libro")
    ingest.ingerir(paginas(spark, 1), libro, "a")
    entregar, visto = ingest.entregar, []

    def tarde(nuevo, carpeta, lote, **como):
        if lote == "l-b" and not visto:
            visto.append(lote)
            ingest.ingerir(paginas(spark, 2, 3), libro, "c")
        return entregar(nuevo, carpeta, lote, **como)

    monkeypatch.setattr(ingest, "entregar", tarde)
    assert ingest.ingerir(paginas(spark, 1, 2, 4), libro, "b") == 1
    assert visto and guardadas(spark, libro) == ["1", "2", "3", "4"]
    d = ingest.guardado(spark, libro)
    assert {r["Consecutivo"]: r["lote"] for r in d.collect()} == {"1": "l-a", "2": "l-c", "3": "l-c", "4": "l-b"}


def test_numeros_de_toda_longitud(spark, tmp_path):
    """No range over strings: 9 and 10000000000 are as far apart as any two."""
    libro = str(tmp_path / "libro")
    todos = [*range(60), *(10**n for n in range(2, 15)), "FV-1-7", "fv-1-7", "", "é 1", "9" * 300]
    assert ingest.ingerir(paginas(spark, *todos), libro, "a") == len(todos)
    nuevos = [1234567890123456, "FV-1-8", "10 "]
    assert ingest.ingerir(paginas(spark, *todos[::3], *nuevos), libro, "b") == len(nuevos)
    assert guardadas(spark, libro) == sorted(map(str, [*todos, *nuevos]))


def indice(spark, tmp_path, monkeypatch, n=3000):
    monkeypatch.setattr(k, "CUBO", 100)
    monkeypatch.setattr(k, "CELDA", 20)
    libro = str(tmp_path / "libro")
    snk.snk_append(spark.range(n).select(F.col("id").cast("string").alias("Consecutivo"),
                                         F.lit(dt.date(2024, 1, 5)).alias("Fecha")), libro, lote="a")
    (parte,) = v.leer(spark, libro)[1].values()
    return [parte | {"ruta": f"{libro}/{v.INDICE}/{parte['carpeta']}"}]


def test_lee_solo_los_cubos_del_lote(spark, tmp_path, monkeypatch):
    partes = indice(spark, tmp_path, monkeypatch)
    assert partes[0]["cubos"] == 32 and partes[0]["claves"] == 3000
    lote = spark.createDataFrame([("5",), ("2999",), ("x",)], "clave string")
    for columna, d in (("bits", k.posibles(lote, partes)), ("clave", k.buscar(lote, partes))):
        p = d._jdf.queryExecution().executedPlan().toString()
        filtro = next(x for x in p.splitlines() if "PartitionFilters" in x and columna in x)
        assert "cubo" in filtro.split("PartitionFilters:")[1].split("]")[0]
    cubos = k._cubos(lote, 32)
    assert 1 <= len(cubos) <= 3
    abiertos = spark.read.schema(k.ESQUEMA_CLAVES).parquet(f"{partes[0]['ruta']}/claves").filter(F.col("cubo").isin(cubos))
    assert abiertos.select(F.input_file_name()).distinct().count() <= 3 < 32
    assert sorted(r[0] for r in k.buscar(lote, partes).collect()) == ["2999", "5"]


def test_filtros_pierden_nada_y_dejan_pasar_poco(spark, tmp_path, monkeypatch):
    partes = indice(spark, tmp_path, monkeypatch)
    lote = spark.range(2500, 6000).select(F.col("id").cast("string").alias("clave"))
    quiza = {int(r[0]) for r in k.posibles(lote, partes).collect()}
    assert quiza >= set(range(2500, 3000))
    assert len(quiza) < 500 + 0.05 * 3000
    assert k.posibles(lote, []) is None


def test_lote_nuevo_no_lee_numeros(spark, tmp_path, monkeypatch):
    libro = str(tmp_path / "libro")
    ingest.ingerir(paginas(spark, *range(40)), libro, "a")
    monkeypatch.setattr(k, "buscar", lambda *a: pytest.fail("the filters answer for new invoices"))
    assert ingest.ingerir(paginas(spark, *range(1000, 1010)), libro, "b") == 10


def test_compactar_en_su_sitio(spark, tmp_path, monkeypatch):
    libro = str(tmp_path / "libro")
    for lote in "abc":
        ingest.ingerir(paginas(spark, lote, f"{lote}2"), libro, lote)
    escribir = snk._escribir

    def tarde(filas, carpeta, id):
        parte = escribir(filas, carpeta, id)
        monkeypatch.setattr(snk, "_escribir", escribir)
        ingest.ingerir(paginas(spark, "d"), libro, "d")
        return parte

    monkeypatch.setattr(snk, "_escribir", tarde)
    snk.compactar(spark, libro)
    assert set(v.leer(spark, libro)[1]) == {snk.COMPACTO, "l-d"}
    assert guardadas(spark, libro) == ["a", "a2", "b", "b2", "c", "c2", "d"]
    # Compacted batches are stored ones: run again they add nothing and can't be replaced.
    assert ingest.ingerir(paginas(spark, "a", "a2", "a3"), libro, "a") == 1
    with pytest.raises(ValueError, match="compacted"):
        snk.snk_append(lineas(spark, 1), libro, lote="b")
    snk.compactar(spark, libro)
    assert set(v.leer(spark, libro)[1]) == {snk.COMPACTO} and len(guardadas(spark, libro)) == 8


def test_tabla_sin_versiones(spark, tmp_path):
    """A ledger of plain files is read, but not written to: its rows would vanish."""
    libro = str(tmp_path / "viejo")
    lineas(spark, 1, 2).withColumns({"mes": F.lit("2024-01"), "lote": F.lit("l-x")}).write.partitionBy("mes", "lote").parquet(libro)
    assert guardadas(spark, libro) == ["1", "2"]
    with pytest.raises(ValueError, match="compactar"):
        snk.snk_append(lineas(spark, 3), libro)
    nuevo = str(tmp_path / "nuevo")
    snk.compactar(spark, libro, nuevo)
    assert ingest.ingerir(paginas(spark, 2, 3), nuevo, "z") == 1 and guardadas(spark, nuevo) == ["1", "2", "3"]


def test_versiones_viejas_se_van(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(v, "RETENER", 3)
    ruta = str(tmp_path / "t")
    for i in range(8):
        v.cambiar(spark, ruta, lambda p: p | {str(i): {"carpeta": f"entrega={i}"}})
    assert v._numeros(spark, ruta) == [6, 7, 8] and len(v.leer(spark, ruta)[1]) == 8
