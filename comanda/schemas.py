"""Column contracts of the warehouse tables and of the normalised sources."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)

DATABASE = "comanda_dw"

# Facts are stored by month of the time key: tiempo_key without day and hour.
PARTITION = "anio_mes"


def _table(*columns: tuple) -> T.StructType:
    fields = []
    for name, kind, *comment in columns:
        fields.append(T.StructField(name, kind, True, {"comment": comment[0]} if comment else None))
    return T.StructType(fields)


WAREHOUSE: dict[str, T.StructType] = {
    "dim_tiempo": _table(
        ("tiempo_key", T.LongType(), "YYYYMMDDhh"),
        ("fecha", T.DateType()),
        ("anio", T.IntegerType()),
        ("trimestre", T.IntegerType()),
        ("mes", T.IntegerType()),
        ("nombre_mes", T.StringType()),
        ("semana", T.IntegerType(), "ISO week; pairs with the ISO year, not with anio"),
        ("dia", T.IntegerType()),
        ("dia_semana", T.IntegerType(), "1=Lunes .. 7=Domingo"),
        ("nombre_dia", T.StringType()),
        ("hora", T.IntegerType()),
        ("es_fin_semana", T.BooleanType()),
    ),
    "dim_usuario": _table(
        ("usuario_key", T.LongType()),
        ("usuario_id", T.StringType()),
        ("nombre", T.StringType()),
        ("rol", T.StringType()),
        ("fecha_registro", T.DateType()),
    ),
    "dim_restaurante": _table(
        ("restaurante_key", T.LongType()),
        ("restaurante_id", T.StringType()),
        ("nombre", T.StringType()),
        ("direccion", T.StringType()),
        ("capacidad", T.IntegerType()),
    ),
    "dim_producto": _table(
        ("producto_key", T.LongType()),
        ("producto_id", T.StringType()),
        ("nombre", T.StringType()),
        ("categoria", T.StringType()),
        ("precio_actual", MONEY),
        ("disponible", T.BooleanType()),
        ("restaurante_id", T.StringType()),
    ),
    "fact_items_pedido": _table(
        ("tiempo_key", T.LongType(), "FK dim_tiempo"),
        ("usuario_key", T.LongType(), "FK dim_usuario"),
        ("restaurante_key", T.LongType(), "FK dim_restaurante"),
        ("producto_key", T.LongType(), "FK dim_producto"),
        ("pedido_id", T.StringType()),
        ("item_id", T.StringType()),
        ("cantidad", T.IntegerType()),
        ("precio_unitario", MONEY, "price when ordered"),
        ("monto_total", MONEY, "cantidad * precio_unitario"),
        ("estado_pedido", T.StringType()),
        ("es_para_llevar", T.BooleanType()),
    ),
    "fact_reservaciones": _table(
        ("tiempo_key", T.LongType(), "FK dim_tiempo"),
        ("usuario_key", T.LongType(), "FK dim_usuario"),
        ("restaurante_key", T.LongType(), "FK dim_restaurante"),
        ("reservacion_id", T.StringType()),
        ("tamano_grupo", T.IntegerType()),
        ("estado", T.StringType()),
    ),
}

# Headered CSV exchange files of the property graph.
GRAPH_FILES: dict[str, T.StructType] = {
    "users": _table(
        ("user_id", T.StringType()), ("name", T.StringType()), ("zone", T.StringType())
    ),
    "products": _table(
        ("product_id", T.StringType()), ("name", T.StringType()),
        ("category", T.StringType()), ("price", MONEY),
    ),
    "orders": _table(
        ("order_id", T.StringType()), ("user_id", T.StringType()),
        ("restaurant_id", T.StringType()), ("created_at", T.StringType()),
        ("status", T.StringType()), ("zone", T.StringType()),
    ),
    "order_items": _table(
        ("order_id", T.StringType()), ("product_id", T.StringType()),
        ("quantity", T.IntegerType()), ("unit_price", MONEY),
    ),
    "recommendations": _table(
        ("from_user_id", T.StringType()), ("to_user_id", T.StringType())
    ),
    "co_purchases": _table(
        ("product_a_id", T.StringType()), ("product_b_id", T.StringType()),
        ("times_bought_together", T.LongType()),
    ),
    "locations": _table(
        ("location_id", T.StringType()), ("name", T.StringType()),
        ("latitude", T.DoubleType()), ("longitude", T.DoubleType()),
    ),
    "route_assignments": _table(
        ("courier_id", T.StringType()), ("stop_order", T.IntegerType()),
        ("order_id", T.StringType()), ("user_id", T.StringType()),
        ("location_id", T.StringType()), ("zone", T.StringType()),
        ("latitude", T.DoubleType()), ("longitude", T.DoubleType()),
        ("distance_from_previous_km", T.DoubleType()),
        ("estimated_minutes", T.DoubleType()), ("accumulated_km", T.DoubleType()),
    ),
    "route_edges": _table(
        ("courier_id", T.StringType()), ("stop_order", T.IntegerType()),
        ("from_location_id", T.StringType()), ("to_location_id", T.StringType()),
        ("distance_from_previous_km", T.DoubleType()),
        ("estimated_minutes", T.DoubleType()),
    ),
}
