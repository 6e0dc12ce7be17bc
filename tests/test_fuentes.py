"""Files, recipes and ingest."""

import datetime as dt
import json

import pytest
from despensa.operators import recipes as r
from despensa.operators.ordered import win_bfill
from despensa.sinks import marts as snk
from despensa.sources import files as src
from despensa.sources import invoices as inv
from despensa.sources import marts as sm
from despensa.streaming import ingest
from pyspark.sql import functions as F

CAB = "Consecutivo,Fecha,Tr,Tc,Codigo,Nombre,Vendedor,Cantidad,Precio,Impuesto,Total,Fp,Nc,Est\n"


def test_ventas(spark, tmp_path):
    (tmp_path / "v.csv").write_text(
        CAB + '1,2024-01-02,S,,c,"Bowl ""rico""\nGrande",v,2,5,0,,e,FV-1,Principal\n'
        "2,31/02/2024,S,,c,Jugo,v,1,5,0,5,e,FV-1,Principal\n"
        "3,2024-01-03,S,,c,Jugo,v,x,5,0,9,e,FV-1,\n", encoding="utf-8")
    v = src.src_ventas(spark, str(tmp_path / "v.csv"), multilinea=True).orderBy("Consecutivo").collect()
    assert [(x["Consecutivo"], x["Nombre"], x["Cantidad"], x["Total"], x["Establecimiento"])
            for x in v] == [("1", 'Bowl "rico"', 2.0, 10.0, "Principal"), ("3", "Jugo", 0.0, 9.0, None)]
    p = src.src_ventas(spark, str(tmp_path / "v.csv"), total="cero", multilinea=True)
    assert p.filter("Consecutivo = '1'").first()["Total"] == 0.0


def test_informes(spark, tmp_path):
    pre = "\n".join(["Empresa", "NIT", "Informe", "Desde", "Hasta", ""]) + "\n"
    fila = ["x"] * 14
    lineas = [",".join(fila)]
    for f, t in (("03/02/2025", '"$1.234,56"'), ("04/02/2025", ""), ("total", "9")):
        fila[1], fila[13] = f, t
        lineas.append(",".join(fila))
    (tmp_path / "CP-2025.csv").write_text(pre + "\n".join(lineas), encoding="utf-8")
    d = src.src_facturas(spark, str(tmp_path / "*.csv")).orderBy("Fecha").collect()
    assert [(x["Fecha"], x["Total"], x["Local"], x["Mes"]) for x in d] == [
        (dt.date(2025, 2, 3), 1234.56, "CP", "2025-02"), (dt.date(2025, 2, 4), 0.0, "CP", "2025-02")]
    (tmp_path / "rep").mkdir()
    (tmp_path / "rep" / "a.csv").write_text(pre + "Tipo,,,Fecha,,,Prov,,Valor\n"
        "Compra/Gasto,,,05/01/2025,,,P1,,10\nPago,,,05/01/2025,,,P1,,10\n"
        "Documento soporte,,,06/01/2025,,,P2,,x\n", encoding="utf-8")
    c = src.src_compras_rep(spark, str(tmp_path / "rep")).orderBy("Fecha").collect()
    assert [(x["Tipo"], x["Proveedor"], x["Valor"]) for x in c] == [
        ("Compra/Gasto", "P1", 10.0), ("Documento soporte", "P2", 0.0)]


def test_reporte_mensual(spark, tmp_path):
    cab = ",".join(src.REPORTE) + "\n"
    filas = [("1", "02/01/2024", "A", ""), ("1", "02/01/2024", "B", ""), ("1", "02/01/2024", "", "efectivo"),
             ("2", "03/01/2024", "C", ""), ("2", "03/01/2024", "", "tarjeta")]
    (tmp_path / "Enero-2024.csv").write_text("x\n" * 7 + cab + "".join(
        f"{n},{f},Secuencia,,{c},Jugo,v,1,5,0,5,{p},FV-1,Factura de venta\n" for n, f, c, p in filas),
        encoding="utf-8")
    d = src.src_reportes_mes(spark, str(tmp_path / "*-2024.csv"))
    d = win_bfill(d, "Forma_pago", ["bloque"], "fila", F.col("inicio"))
    d = d.filter("Codigo IS NOT NULL").orderBy("Codigo").collect()
    assert [(x["Codigo"], x["Forma_pago"], x["archivo"]) for x in d] == [
        ("A", "efectivo", "Enero-2024"), ("B", "efectivo", "Enero-2024"), ("C", "tarjeta", "Enero-2024")]


def test_recetas(spark, tmp_path):
    (tmp_path / "Bowls.csv").write_text(
        "1,Porcion,Receta,Ingrediente,Cantidad,Unidad\n2,350 g,Pollo,arroz,100,g\n3,,,pollo,80,g\n"
        "4,,,salsa,al gusto,\n5,,Res,arroz,90,g\n6,,, ,,\n", encoding="utf-8")
    q = src.src_recetas(spark, str(tmp_path / "*.csv"))
    assert [tuple(x)[:6] for x in q.orderBy("orden").collect()] == [
        ("Bowls", "Pollo", "350 g", "arroz", "100", "g"), ("Bowls", "Pollo", "350 g", "pollo", "80", "g"),
        ("Bowls", "Pollo", "350 g", "salsa", "al gusto", ""), ("Bowls", "Res", None, "arroz", "90", "g")]
    f = spark.createDataFrame([("Bowl Pollo Grande (21k)", 3.0), ("Milo", 5.0)],
                              "producto string, prediccion double")
    mapa = r.jn_receta(q, f)
    assert {x[0]: x[1] for x in mapa.collect()} == {"Bowl Pollo Grande (21k)": "Pollo", "Milo": None}
    ins = r.agg_insumos(r.jn_explosion(f, mapa, q)).collect()
    assert [(x["ingrediente"], x["cantidad"]) for x in ins] == [
        ("arroz", 300.0), ("pollo", 240.0), ("salsa", 0.0)]


def test_mapeo_fuerza_bruta(spark):
    from despensa.functions.text import cln_acentos, cln_variantes, cln_venta
    platos = ["Pollo", "Pollo Thai", "César", "Thai", "a", "Romano Mediano", "Té verde", "Cesar "]
    ventas = ["Bowl Pollo thai mediana", "Ensalada Cesar", "Sándwich Romano mediana", "thai", "verde",
              "Jugo de mora", "Té", "zzz", "Pollo", "(x)"]
    rec = spark.createDataFrame([(p, i) for i, p in enumerate(platos)], "plato string, orden int")
    nom = spark.createDataFrame([(v,) for v in ventas], "producto string")
    norm = [(x[0], x[1]) for x in rec.orderBy("orden").select("plato", cln_acentos("plato")).collect()]
    var = {x[0]: x[1] for x in nom.select("producto", cln_variantes(cln_venta("producto"))).collect()}

    def bruto(vs):
        for prueba in (lambda v, n: v == n, lambda v, n: v and (v in n or n in v)):
            for v in vs:
                for p, n in norm:
                    if prueba(v, n):
                        return p
        return None

    assert {x[0]: x[1] for x in r.jn_receta(rec, nom).collect()} == {v: bruto(var[v]) for v in ventas}


FACTURAS = {"results": [
    {"date": "2024-01-02", "number": 7, "seller": "s", "total": 90, "payments": [
        {"payment_method_id": 3}], "cost_center": {"name": "CP"}, "items": [
        {"code": "a", "description": "Jugo Grande", "quantity": 0, "price": 5, "taxes": None},
        {"code": "b", "description": "Bowl", "quantity": 2, "price": 10,
         "taxes": [{"value": 1}, {"value": None}, {"value": 2}]}]},
    {"date": "2024-01-03", "number": 8, "total": 50, "items": [], "cost_center": None}],
    "pagination": {"total_results": 2}}


def test_facturas(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps(FACTURAS, indent=1))
    d = inv.normalizar(inv.lineas_de_facturas(
        inv.src_facturas_json(spark, str(tmp_path), paginas=True))).orderBy("Consecutivo", "Codigo")
    assert [(x["Consecutivo"], x["Nombre"], x["Cantidad"], x["Precio"], x["Impuesto"], x["Total"],
             x["Forma_pago"], x["Establecimiento"]) for x in d.collect()] == [
        ("7", "Jugo", 1.0, 5.0, 0.0, 5.0, "3", "CP"), ("7", "Bowl", 2.0, 10.0, 3.0, 23.0, "3", "CP"),
        ("8", "", 1.0, 50.0, 0.0, 50.0, "", "Principal")]


def test_ingesta(spark, tmp_path):
    entrada = tmp_path / "in"
    entrada.mkdir()
    (entrada / "p1.json").write_text(json.dumps(FACTURAS))
    pag = inv.src_facturas_json(spark, str(entrada))
    lote, flujo = str(tmp_path / "lote"), str(tmp_path / "flujo")
    assert ingest.ingerir(pag, lote, "1") == 3
    assert ingest.ingerir(pag, lote, "2") == 0
    assert ingest.ingerir(pag, lote, "1") == 3  # the batch run again replaces itself
    assert ingest.guardado(spark, lote).count() == 3
    otra = {"results": [{"date": "2024-02-01", "number": 9, "total": 1, "items": []},
                        {"date": "2024-01-02", "number": 7, "total": 1, "items": []}]}
    for n, doc in (("p1.json", FACTURAS), ("p2.json", otra), ("p3.json", otra)):
        (entrada / n).write_text(json.dumps(doc))
        ingest.stm_ingesta(spark, str(entrada), flujo, str(tmp_path / "control")).awaitTermination()
        ingest.ingerir(inv.src_facturas_json(spark, str(entrada / n)), lote, n)
    assert sorted(x[0] for x in ingest.guardado(spark, flujo).select("Consecutivo").collect()) == [
        "7", "7", "8", "9"]
    cols = [c for c in ingest.guardado(spark, lote).columns if c != "lote"]
    a, b = (ingest.guardado(spark, x).select(*cols) for x in (lote, flujo))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dos_flujos(spark, tmp_path):
    """A second stream, or one whose control folder is new, adds to the ledger."""
    libro = str(tmp_path / "libro")
    for k, numero in enumerate((1, 2, 1)):
        entrada = tmp_path / f"in{k}"
        entrada.mkdir()
        doc = {"results": [{"date": "2024-02-01", "number": numero, "total": "1.5", "items": []}]}
        (entrada / "p.json").write_text(json.dumps(doc))
        ingest.stm_ingesta(spark, str(entrada), libro, str(tmp_path / f"control{k}")).awaitTermination()
    d = ingest.guardado(spark, libro).orderBy("Consecutivo").collect()
    assert [(x["Consecutivo"], x["Total"]) for x in d] == [("1", 1.5), ("2", 1.5)]


def test_dos_anexos(spark, tmp_path):
    d = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 2, 5))], "k int, Fecha date")
    libro = str(tmp_path / "libro")
    assert snk.snk_append(d, libro) != snk.snk_append(d, libro)
    assert snk.snk_append(d, libro, lote="a") == snk.snk_append(d, libro, lote="a") == "l-a"
    assert ingest.guardado(spark, libro).count() == 6
    snk.compactar(spark, libro, str(tmp_path / "nuevo"))
    n = ingest.guardado(spark, str(tmp_path / "nuevo"))
    assert n.count() == 6 and n.select("lote").distinct().count() == 1


def test_paginas_malas(spark, tmp_path):
    entrada = tmp_path / "in"
    entrada.mkdir()
    buena = {"results": [{"date": "2024-01-02", "number": "5", "items": [
        {"code": "a", "quantity": "3", "price": "2.5", "taxes": [{"value": "1"}]}]}]}
    (entrada / "a.json").write_text(json.dumps(buena))
    (entrada / "b.json").write_text(json.dumps(buena)[:40])
    (entrada / "c.json").write_text('{"error": "limit"}')
    libro = str(tmp_path / "libro")
    assert ingest.ingerir(inv.src_facturas_json(spark, str(entrada)), libro, "1") == 1
    x = ingest.guardado(spark, libro).first()
    assert (x["Cantidad"], x["Precio"], x["Impuesto"], x["Total"]) == (3.0, 2.5, 1.0, 8.5)
    assert spark.read.parquet(ingest.rechazos(libro)).count() == 2
    (entrada / "d.json").write_text(json.dumps(buena, indent=1))
    flujo = str(tmp_path / "flujo")
    ingest.stm_ingesta(spark, str(entrada), flujo, str(tmp_path / "ctl"), paginas=True).awaitTermination()
    assert ingest.guardado(spark, flujo).count() == 2 and spark.read.parquet(ingest.rechazos(flujo)).count() == 2


def test_libro_ilegible(spark, tmp_path):
    (tmp_path / "libro").mkdir()
    (tmp_path / "libro" / "x.parquet").write_text("no parquet")
    assert ingest.guardado(spark, str(tmp_path / "nada")) is None
    with pytest.raises(Exception):
        ingest.guardado(spark, str(tmp_path / "libro")).count()


def test_local_sin_guion(spark, tmp_path):
    fila = ["x"] * 14
    fila[1], fila[13] = "3/2/2025", "5"
    for n in ("Principal.csv", "CP-2025-01.csv"):
        (tmp_path / n).write_text(",".join(fila))
    d = src.src_facturas(spark, str(tmp_path / "*.csv")).orderBy("Local").collect()
    assert [(x["Local"], x["Fecha"]) for x in d] == [
        ("CP", dt.date(2025, 2, 3)), ("Principal", dt.date(2025, 2, 3))]


def test_un_archivo_en_varias_tareas(spark, tmp_path):
    (tmp_path / "v.csv").write_text(CAB + "1,2024-01-02,S,,c,Jugo,v,1,5,0,5,e,FV-1,CP\n" * 60_000)
    antes = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        v = src.src_ventas(spark, str(tmp_path / "v.csv"))
        assert v.rdd.getNumPartitions() > 2 and v.count() == 60_000
        assert src.src_ventas(spark, str(tmp_path / "v.csv"), multilinea=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", antes)


def test_marts_ausentes(spark, tmp_path):
    m = sm.src_marts(spark, str(tmp_path / "nada"))
    assert set(m) == {"predicciones_top10", "predicciones_4_semanas", "historial_walkforward",
                      "precios_unitarios"} and all(d.count() == 0 for d in m.values())
    snk.snk_meta(spark, str(tmp_path), spark.range(1).select(F.lit(12).alias("n")), "2026-05-03T15:06:57")
    assert sm.src_meta(spark, str(tmp_path)).first()["fecha_modelo"] == "2026-05-03 15:06"
