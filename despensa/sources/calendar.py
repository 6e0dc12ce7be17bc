"""Academic calendar, public holidays and term starts.

All of these are dimension tables whose size is set by the calendar, not by the data, so they are
safe to broadcast.
"""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from dateutil.easter import easter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despensa.soporte import dimension

# ---- fixed values: calendar blocks in precedence order (a later block wins on a shared day) ----
BLOQUES = [
    ("semana_santa", "2024-03-24", "2024-03-30"),
    ("semana_receso_verano", "2024-03-18", "2024-03-23"),
    ("examenes_finales", "2024-05-27", "2024-06-01"),
    ("vacaciones_verano", "2024-06-02", "2024-08-04"),
    ("semana_receso_invierno", "2024-09-30", "2024-10-05"),
    ("examenes_finales", "2024-12-02", "2024-12-07"),
    ("vacaciones_invierno", "2024-12-08", "2025-01-20"),
    ("semana_receso_verano", "2025-03-17", "2025-03-22"),
    ("semana_santa", "2025-04-13", "2025-04-19"),
    ("examenes_finales", "2025-05-26", "2025-05-31"),
    ("vacaciones_verano", "2025-06-01", "2025-08-03"),
    ("semana_receso_invierno", "2025-09-29", "2025-10-04"),
    ("examenes_finales", "2025-12-01", "2025-12-06"),
    ("vacaciones_invierno", "2025-12-07", "2026-01-19"),
    ("semana_receso_verano", "2026-03-16", "2026-03-21"),
    ("semana_santa", "2026-03-29", "2026-04-04"),
    ("examenes_finales", "2026-05-25", "2026-05-30"),
    ("vacaciones_verano", "2026-05-31", "2026-08-02"),
    ("semana_receso_invierno", "2026-09-28", "2026-10-03"),
    ("examenes_finales", "2026-11-30", "2026-12-05"),
    ("vacaciones_invierno", "2026-12-06", "2027-01-18"),
    ("cierre_oct_dic_2024", "2024-10-01", "2024-12-31"),
    ("induccion_pregrado", "2024-01-17", "2024-01-19"),
    ("induccion_pregrado", "2024-07-31", "2024-08-02"),
    ("induccion_pregrado", "2025-01-15", "2025-01-17"),
    ("induccion_pregrado", "2025-07-30", "2025-08-01"),
    ("induccion_pregrado", "2026-01-13", "2026-01-15"),
    ("induccion_pregrado", "2026-07-28", "2026-07-30"),
]
INICIOS = ["2024-01-22", "2024-08-05", "2025-01-20", "2025-08-04", "2026-01-19", "2026-08-03"]
# Public holidays of Colombia: on the day, moved to the next Monday, or counted from Easter.
FIJOS = [("Año Nuevo", 1, 1), ("Día del Trabajo", 5, 1), ("Día de la Independencia", 7, 20),
         ("Batalla de Boyacá", 8, 7), ("La Inmaculada Concepción", 12, 8), ("Navidad", 12, 25)]
TRASLADADOS = [("Día de los Reyes Magos", 1, 6), ("Día de San José", 3, 19),
               ("San Pedro y San Pablo", 6, 29), ("La Asunción", 8, 15), ("Día de la Raza", 10, 12),
               ("Día de Todos los Santos", 11, 1), ("Independencia de Cartagena", 11, 11)]
PASCUA = [("Jueves Santo", -3), ("Viernes Santo", -2), ("Ascensión del señor", 43),
          ("Corpus Christi", 64), ("Sagrado Corazón", 71)]
# ------------------------------------------------------------------------------------------------

NOMBRES = list(dict.fromkeys(b[0] for b in BLOQUES))


def _dia(texto: str, dias_atras: int) -> dt.date:
    return dt.date.fromisoformat(texto) - dt.timedelta(days=dias_atras)


def bloques(spark: SparkSession, dias_atras: int = 0) -> DataFrame:
    """Calendar periods (ord, holiday, ini, fin), optionally moved back by some days."""
    return dimension(
        spark,
        ord=(pa.int32(), list(range(len(BLOQUES)))),
        holiday=(pa.string(), [b[0] for b in BLOQUES]),
        ini=(pa.date32(), [_dia(b[1], dias_atras) for b in BLOQUES]),
        fin=(pa.date32(), [_dia(b[2], dias_atras) for b in BLOQUES]),
    )


def src_calendario(spark: SparkSession, dias_atras: int = 0) -> DataFrame:
    """One row per holiday and day."""
    dias = F.explode(F.sequence("ini", "fin", F.expr("interval 1 day")))
    return bloques(spark, dias_atras).select(
        "holiday", dias.alias("ds"), F.lit(0).alias("lower_window"),
        F.lit(0).alias("upper_window"), "ord")


def src_inicios(spark: SparkSession, dias_atras: int = 0) -> DataFrame:
    return dimension(spark, inicio=(pa.date32(), [_dia(d, dias_atras) for d in INICIOS]))


def src_festivos(spark: SparkSession, desde: int, hasta: int) -> DataFrame:
    """Public holidays (holiday, ds) of the years ``desde`` to ``hasta``: 18 rows a year."""
    filas = []
    for a in range(desde, hasta + 1):
        filas += [(n, dt.date(a, m, d)) for n, m, d in FIJOS]
        for n, m, d in TRASLADADOS:
            dia = dt.date(a, m, d)
            filas.append((n, dia + dt.timedelta(days=-dia.weekday() % 7)))
        filas += [(n, easter(a) + dt.timedelta(days=k)) for n, k in PASCUA]
    return dimension(spark, holiday=(pa.string(), [f[0] for f in filas]),
                     ds=(pa.date32(), [f[1] for f in filas]))
