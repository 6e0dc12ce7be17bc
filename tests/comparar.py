"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import time

import duckdb


def conexion(ruta: str):
    c = duckdb.connect()
    for f in sorted(glob.glob(f"{ruta}/*.parquet")):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def _v(x):
    if x is None:
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, dt.date):
        return x.isoformat()
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, int):
        return repr(x)
    if isinstance(x, (list, tuple)):
        return tuple(_v(i) for i in x)
    return str(x)


def filas_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_v(r[c]) for c in cols) for r in df.collect()), key=repr)


def filas_duck(c, sql):
    r = c.execute(sql)
    nombres = [d[0] for d in r.description]
    orden = sorted(range(len(nombres)), key=lambda i: nombres[i])
    return [nombres[i] for i in orden], sorted(
        (tuple(_v(f[i]) for i in orden) for f in r.fetchall()), key=repr)


def comparar(spark, c, clave, consulta, sql, ruta):
    t = time.time()
    cols, a = filas_spark(consulta(spark, ruta))
    seg = time.time() - t
    if sql is None:
        return True, f"{len(a)} rows, no SQL", seg
    cd, b = filas_duck(c, sql)
    if cols != cd:
        return False, f"columns {cols} / {cd}", seg
    if a == b:
        return True, f"{len(a)} rows", seg
    fuera = [x for x in zip(a, b) if x[0] != x[1]][:2]
    return False, f"{len(a)}/{len(b)} rows, first difference {fuera}", seg


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from despensa.session import crear_sesion

    ruta = os.environ.get("SF", "/root/testdata/sf0.01")
    spark = crear_sesion("local[8]", spark__sql__shuffle__partitions="8",
                         spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    q, s = e.queries(), e.oracle_sql()
    claves = sys.argv[1:] or list(q)
    c = conexion(ruta)
    malas = 0
    for k in claves:
        try:
            ok, nota, seg = comparar(spark, c, k, q[k], s.get(k), ruta)
        except Exception as x:  # report and go on with the next query
            ok, nota, seg = False, f"{type(x).__name__}: {str(x)[:700]}", 0.0
        malas += not ok
        print(("ok  " if ok else "BAD ") + f"{k:24s} {seg:6.2f}s {nota}", flush=True)
    print(f"{len(claves)} queries, {malas} bad")
