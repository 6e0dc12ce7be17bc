"""Schemas of the input files and of the output marts."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: columns of the input files, nested documents and marts, accents left out ----
VENTAS = [
    "Consecutivo", "Fecha", "Tipo_reg", "Tipo_clas", "Codigo", "Nombre", "Vendedor",
    "Cantidad", "Precio", "Impuesto", "Total", "Forma_pago", "Num_comp", "Establecimiento",
]
COMPRAS = [
    "Consecutivo", "Factura", "ID", "Proveedor", "Fecha_c", "Fecha_m", "Fecha", "Contacto",
    "Tipo_reg", "Tipo_clas", "Codigo", "Nombre", "Cantidad", "Precio", "Total", "Forma_pago",
    "Fecha_v", "Periodo",
]
CATALOGO = ["Nombre", "Trans", "Cant_total", "Precio_prom", "Ingresos_total", "Categoria"]
RECETAS = ["categoria", "plato", "porcion", "ingrediente", "cantidad", "unidad"]


def texto(nombres: list[str]) -> T.StructType:
    """All-string schema: files are read as text and coerced afterwards."""
    return T.StructType([T.StructField(n, T.StringType()) for n in nombres])


# One landed page of the invoice service. Given in full: inference would turn a null
# cost_center into a string. Numbers are read as text, since some come quoted. A page that does
# not parse keeps its text in _malo.
FACTURAS_JSON = """
    results array<struct<
      date: string, number: string, seller: string, total: string,
      payments: array<struct<payment_method_id: string>>,
      cost_center: struct<name: string>,
      items: array<struct<code: string, description: string, quantity: string, price: string,
                          taxes: array<struct<value: string>>>>>>,
    pagination struct<total_results: bigint>, _malo string
"""

MARTS = {
    "predicciones_top10": (
        "producto string, n_semanas bigint, fecha_proxima_semana date, prediccion double, "
        "prophet_solo double, mae_hibrido double, smape_hibrido double, mae_prophet double, "
        "mejora_mae double, std_residual double"
    ),
    "predicciones_4_semanas": (
        "producto string, semana_offset int, fecha date, prediccion double, "
        "prediccion_lower double, prediccion_upper double, prophet_solo double, confianza_pct int"
    ),
    "historial_walkforward": (
        "ds date, real double, prediccion double, prophet double, producto string"
    ),
    "precios_unitarios": "producto string, precio_unitario double",
}
METADATOS = "ultima_actualizacion string, n_productos bigint"
