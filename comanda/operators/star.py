"""Dimensions, facts and the star they form."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.functions.calendar import (
    calendar_columns,
    calendar_parts,
    date_of_key,
    hour_key,
    hour_of_key,
    month_name,
)
from comanda.functions.keys import distinct_keys, one_per_key, surrogate_key
from comanda.functions.numbers import line_amount
from comanda.schemas import MONEY, PARTITION, WAREHOUSE
from comanda.session import materialise
from comanda.sinks.warehouse import STAR, current_load, read_load
from comanda.sources.tables import LazyTables, Tables


class Star(LazyTables):
    """The four dimensions and two facts.

    ``natural`` says that facts hold the natural ids of their members as well,
    by which a composed star joins: its hash keys need not be told apart then.
    """

    NAMES = tuple(WAREHOUSE)

    def __init__(self, natural: bool = False, **tables):
        super().__init__(**tables)
        self.natural = natural

    def key(self, dim: str) -> str:
        """The column by which facts name a member of a dimension."""
        return f"{dim}_id" if self.natural else f"{dim}_key"

    def with_calendar(self, fact: DataFrame) -> DataFrame:
        """The fact's rows of known hours, with the calendar's columns.

        These are functions of the time key, which a fact only has if its hour
        is known, so no table is joined. Year and month come from the folder a
        stored fact lies in: a filter on them reads no other month.
        """
        key = F.col("tiempo_key")
        columns = {c: column for c, column in calendar_parts(date_of_key(key), hour_of_key(key))}
        del columns["tiempo_key"]
        if PARTITION in fact.columns:
            columns["anio"] = F.expr(f"cast({PARTITION} div 100 as int)")
            columns["mes"] = F.expr(f"cast({PARTITION} % 100 as int)")
            columns["nombre_mes"] = month_name(columns["mes"])
        return fact.where(key.isNotNull()).select("*", *[c.alias(n) for n, c in columns.items()])


def dim_tiempo(orders: DataFrame, reservations: DataFrame) -> DataFrame:
    """One row per hour in which something was ordered or reserved.

    Times are cut to the hour before the distinct, so tasks send on at most
    one row per hour they saw.
    """
    stamps = orders.select(F.col("created_at").try_cast("timestamp").alias("ts")).unionByName(
        reservations.select(F.col("date").try_cast("timestamp").alias("ts"))
    )
    hours = (
        stamps.where(F.col("ts").isNotNull())
        .select(F.to_date("ts").alias("fecha"), F.hour("ts").alias("hora"))
        .distinct()
    )
    return hours.select(*calendar_columns(F.col("fecha"), F.col("hora")))


def _keyed(df: DataFrame, natural: str, key: str, strategy: str) -> DataFrame:
    keyed = df.select(surrogate_key(F.col(natural), strategy).alias(key), *df.columns)
    return distinct_keys(keyed, key, natural)


def _members(source: DataFrame, *columns: str) -> DataFrame:
    """The newest row per id, of the given columns only.

    Rows without an id go: nothing can refer to them.
    """
    newest = [name for name in ("updated_at", "created_at") if name in source.columns]
    others = dict.fromkeys((*columns, *newest))
    known = source.where(F.col("id").isNotNull())
    return one_per_key(known.select(F.col("id").cast("string").alias("id"), *others), "id", newest)


def dim_usuario(users: DataFrame, key_strategy: str = "xxhash64") -> DataFrame:
    """One row per user; whatever else the source holds stays behind."""
    dim = _members(users, "name", "role", "created_at").select(
        F.col("id").alias("usuario_id"),
        F.col("name").alias("nombre"),
        F.col("role").alias("rol"),
        F.col("created_at").try_cast("timestamp").cast("date").alias("fecha_registro"),
    )
    return _keyed(dim, "usuario_id", "usuario_key", key_strategy)


def dim_restaurante(restaurants: DataFrame, key_strategy: str = "xxhash64") -> DataFrame:
    dim = _members(restaurants, "name", "address", "capacity").select(
        F.col("id").alias("restaurante_id"),
        F.col("name").alias("nombre"),
        F.col("address").alias("direccion"),
        F.col("capacity").try_cast("int").alias("capacidad"),
    )
    return _keyed(dim, "restaurante_id", "restaurante_key", key_strategy)


def dim_producto(products: DataFrame, key_strategy: str = "xxhash64") -> DataFrame:
    """One row per product with its current price."""
    columns = ("name", "category", "price", "available", "restaurant_id")
    dim = _members(products, *columns).select(
        F.col("id").alias("producto_id"),
        F.col("name").alias("nombre"),
        F.col("category").alias("categoria"),
        F.col("price").try_cast(MONEY).alias("precio_actual"),
        F.col("available").try_cast("boolean").alias("disponible"),
        F.col("restaurant_id").cast("string").alias("restaurante_id"),
    )
    return _keyed(dim, "producto_id", "producto_key", key_strategy)


def _conform(df: DataFrame, dims: Star | None, name: str, source: str, strategy: str) -> DataFrame:
    """Put a member's key and id for the source's reference, NULL if unknown.

    Without dimensions both come from the reference itself; an inner join with
    the dimension then drops the same rows.
    """
    own = F.col(source).cast("string")
    key = surrogate_key(own, strategy)
    if dims is None:
        return df.withColumns({f"{name}_key": key, f"{name}_id": own}).drop(source)
    other = _other_keys(df.select(own.alias("_ref")), dims, name, strategy)
    found = df.withColumn("_own", own).join(other, F.col("_own") == F.col("_ref"), "left")
    plain = F.col("_ref").isNull()
    return found.withColumns(
        {
            f"{name}_key": F.when(plain, surrogate_key(F.col("_own"), strategy)).otherwise(F.col("_key")),
            f"{name}_id": F.when(plain | F.col("_key").isNotNull(), F.col("_own")),
        }
    ).drop(source, "_own", "_ref", "_key")


def _other_keys(references: DataFrame, dims: Star, name: str, strategy: str) -> DataFrame:
    """References whose member has another key than their hash, or that no member has (NULL).

    Mostly there are none or few. They are written, in a job while the plan is
    built, so that their size tells the planner to broadcast them: a dimension
    of any size is then met by distinct references, and facts aren't shuffled
    for it. The reference column is read once more for that.
    """
    member = getattr(dims, f"dim_{name}").select(F.col(f"{name}_id").alias("_id"), F.col(f"{name}_key").alias("_key"))
    known = references.where(F.col("_ref").isNotNull()).distinct()
    met = known.join(member, F.col("_ref") == F.col("_id"), "left")
    other = met.where(F.col("_key").isNull() | (F.col("_key") != surrogate_key(F.col("_ref"), strategy)))
    return materialise(other.select("_ref", "_key"), f"other-{name}")


def _known_hours(df: DataFrame, dims: Star | None) -> DataFrame:
    """NULL the time keys of hours that the calendar lacks."""
    if dims is None:
        return df
    hours = dims.dim_tiempo.select(F.col("tiempo_key").alias("_hour"))
    return df.join(hours, F.col("tiempo_key") == F.col("_hour"), "left").withColumn(
        "tiempo_key", F.col("_hour")
    ).drop("_hour")


def fact_items_pedido(
    orders: DataFrame,
    order_items: DataFrame,
    dims: Star | None = None,
    key_strategy: str = "xxhash64",
    natural: bool = False,
) -> DataFrame:
    """One row per order item, with the attributes of its order.

    User, restaurant and hour are an order's, so they are looked up there; the
    lines are shuffled for their order and their product only. Orders and items
    meet on the keys as the source types them; ids become text afterwards.
    ``natural`` adds the members' ids.
    """
    own, other = orders.schema["id"].dataType, order_items.schema["order_id"].dataType
    key_type = own if own == other else T.StringType()
    heads = orders.select(
        F.col("id").cast(key_type).alias("order_id"),
        "user_id",
        "restaurant_id",
        F.col("status").alias("estado_pedido"),
        F.col("pickup").try_cast("boolean").alias("es_para_llevar"),
        hour_key(F.col("created_at").try_cast("timestamp")).alias("tiempo_key"),
    )
    heads = _conform(heads, dims, "usuario", "user_id", key_strategy)
    heads = _conform(heads, dims, "restaurante", "restaurant_id", key_strategy)
    heads = _known_hours(heads, dims)
    lines = order_items.select(
        F.col("id").cast("string").alias("item_id"),
        F.col("order_id").cast(key_type).alias("order_id"),
        "product_id",
        F.col("quantity").try_cast("int").alias("cantidad"),
        F.col("price").try_cast(MONEY).alias("precio_unitario"),
    )
    fact = _conform(lines.join(heads, "order_id"), dims, "producto", "product_id", key_strategy)
    fact = fact.withColumns(
        {
            "pedido_id": F.col("order_id").cast("string"),
            "monto_total": line_amount(F.col("cantidad"), F.col("precio_unitario")),
        }
    )
    return _shaped(fact, "fact_items_pedido", natural, ("usuario", "restaurante", "producto"))


def fact_reservaciones(
    reservations: DataFrame,
    dims: Star | None = None,
    key_strategy: str = "xxhash64",
    natural: bool = False,
) -> DataFrame:
    """One row per reservation, placed at the hour it is for."""
    booked = reservations.select(
        F.col("id").cast("string").alias("reservacion_id"),
        "user_id",
        "restaurant_id",
        F.col("party_size").try_cast("int").alias("tamano_grupo"),
        F.col("status").cast("string").alias("estado"),
        hour_key(F.col("date").try_cast("timestamp")).alias("tiempo_key"),
    )
    fact = _conform(booked, dims, "usuario", "user_id", key_strategy)
    fact = _conform(fact, dims, "restaurante", "restaurant_id", key_strategy)
    return _shaped(
        _known_hours(fact, dims), "fact_reservaciones", natural, ("usuario", "restaurante")
    )


def _shaped(fact: DataFrame, table: str, natural: bool, dims: tuple[str, ...]) -> DataFrame:
    ids = [f"{name}_id" for name in dims] if natural else []
    return fact.select(*WAREHOUSE[table].fieldNames(), *ids)


def build_star(
    source: Tables, resolve: bool = True, key_strategy: str = "xxhash64"
) -> Star:
    """Compose the star from the operational tables.

    ``resolve`` looks every foreign key up in its dimension, as a stored star
    needs. A query that joins the dimensions itself can do without. Each table
    is composed when first asked for.
    """
    star = Star(
        natural=not resolve,
        dim_tiempo=lambda: dim_tiempo(source.orders, source.reservations),
        dim_usuario=lambda: dim_usuario(source.users, key_strategy),
        dim_restaurante=lambda: dim_restaurante(source.restaurants, key_strategy),
        dim_producto=lambda: dim_producto(source.products, key_strategy),
        fact_items_pedido=lambda: fact_items_pedido(
            source.orders, source.order_items, star if resolve else None, key_strategy, natural=not resolve
        ),
        fact_reservaciones=lambda: fact_reservaciones(
            source.reservations, star if resolve else None, key_strategy, natural=not resolve
        ),
    )
    return star


def read_star(spark: SparkSession, database: str) -> Star:
    """The star as the load that is shown now wrote it.

    All tables are of that load, also in queries that are run after the next
    one; read the star again to see that.
    """
    load = current_load(spark, STAR, database)
    if load is None:
        raise LookupError(f"no load has been published in {database}")
    return Star(**{name: partial(read_load, spark, name, load, database) for name in WAREHOUSE})
