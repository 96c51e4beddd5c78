"""Named extracts over the operational tables, and ad-hoc SQL on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.sources.tables import Tables

# Fixed values -- the columns of each extract: source column, and its name there.
EXTRACTS: dict[str, dict[str, dict[str, str]]] = {
    "orders_with_items": {
        "orders": {
            "id": "order_id", "user_id": "user_id", "restaurant_id": "restaurant_id",
            "reservation_id": "reservation_id", "total": "total", "status": "order_status",
            "pickup": "pickup", "created_at": "order_created_at",
        },
        "order_items": {
            "id": "item_id", "product_id": "product_id", "quantity": "quantity",
            "price": "item_price",
        },
    },
    "reservations": {
        "reservations": {
            "id": "id", "restaurant_id": "restaurant_id", "user_id": "user_id", "date": "date",
            "party_size": "party_size", "status": "status", "created_at": "created_at",
        },
    },
    "users": {
        "users": {"id": "id", "name": "name", "role": "role", "created_at": "fecha_registro"},
    },
    "restaurants": {
        "restaurants": {"id": "id", "name": "name", "address": "address", "capacity": "capacity"},
    },
    "products": {
        "products": {
            "id": "id", "name": "name", "category": "category", "price": "price",
            "available": "available", "restaurant_id": "restaurant_id",
        },
    },
}


def run_sql(spark: SparkSession, tables: Tables, sql: str) -> DataFrame:
    """Run SQL that names tables as ``{orders}``, ``{products}``, ..."""
    return spark.sql(sql, **{name: df for name, df in tables.items()})


def _columns(tables: Tables, table: str, names: dict[str, str], *more: str) -> DataFrame:
    """A table's extract columns; one that the source lacks is NULL."""
    df = getattr(tables, table)
    found = [(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(n) for c, n in names.items()]
    return df.select(*found, *more)


def extract(tables: Tables, name: str) -> DataFrame:
    """The rows of one extract; items come with the columns of their order."""
    parts = EXTRACTS[name]
    if name != "orders_with_items":
        ((table, names),) = parts.items()
        return _columns(tables, table, names)
    heads = _columns(tables, "orders", parts["orders"])
    lines = _columns(tables, "order_items", parts["order_items"], "order_id")
    return heads.join(lines, "order_id").select(*heads.columns, *parts["order_items"].values())
