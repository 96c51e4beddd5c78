"""The property graph as tables: nodes, edges and the questions asked of it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.constants import (
    DELIVERY_NAME_PREFIX,
    DEPOT_ID,
    DEPOT_LATITUDE,
    DEPOT_LONGITUDE,
    DEPOT_NAME,
)
from comanda.functions.keys import one_per_key
from comanda.functions.numbers import line_amount, money_sum
from comanda.operators.basket import co_purchases
from comanda.operators.routing import route_edges
from comanda.schemas import GRAPH_FILES
from comanda.sources.tables import Tables


@dataclass(frozen=True)
class Nodes:
    users: DataFrame
    products: DataFrame
    orders: DataFrame
    locations: DataFrame
    couriers: DataFrame
    stops: DataFrame


@dataclass(frozen=True)
class Edges:
    placed: DataFrame
    contains: DataFrame
    recommends: DataFrame
    bought_together: DataFrame
    has_stop: DataFrame
    delivers_order: DataFrame
    delivers_to: DataFrame
    route_to: DataFrame


# Keys that must be unique, per node table.
NODE_KEYS = {
    "users": ("user_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "couriers": ("courier_id",),
    "locations": ("location_id",),
    "stops": ("courier_id", "stop_order"),
}
# Keys of the edges, per edge table.
EDGE_KEYS = {
    "placed": ("user_id", "order_id"),
    "contains": ("order_id", "product_id"),
    "recommends": ("from_user_id", "to_user_id"),
    "bought_together": ("product_a_id", "product_b_id"),
    "has_stop": ("courier_id", "stop_order"),
    "delivers_order": ("courier_id", "stop_order", "order_id"),
    "delivers_to": ("order_id", "location_id"),
    "route_to": ("courier_id", "stop_order", "from_location_id", "to_location_id"),
}


def recommendations(users: DataFrame) -> DataFrame:
    """(from, to): the referrer of every referred user, and that user."""
    ends = {"from_user_id": "referred_by", "to_user_id": "user_id"}
    return users.selectExpr(*[f"{c} {name}" for name, c in ends.items()]).dropna(subset=["from_user_id"])


def delivery_locations(
    routes: DataFrame, depot: tuple[float, float] = (DEPOT_LATITUDE, DEPOT_LONGITUDE)
) -> DataFrame:
    """The depot and one place per delivered order."""
    kinds = GRAPH_FILES["locations"]
    named = routes.withColumn("name", F.concat(F.lit(DELIVERY_NAME_PREFIX), "order_id"))
    stops = named.select(*kinds.fieldNames()).distinct()
    return routes.sparkSession.createDataFrame([(DEPOT_ID, DEPOT_NAME, *depot)], kinds).unionByName(stops)


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """``old`` with the rows of ``new`` put in, replacing rows of equal key."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return new.unionByName(kept.select(*new.columns))


def _between_known(edges: DataFrame, ends: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Keep the edges whose named ends exist."""
    columns = edges.columns
    for column, (nodes, key) in ends.items():
        edges = edges.join(nodes.select(F.col(key).alias(column)), column, "left_semi")
    return edges.select(*columns)


def build_nodes(data: Tables, routes: DataFrame, locations: DataFrame | None = None) -> Nodes:
    """One row per key and label; of repeated keys one row is kept."""
    stops = routes.select(
        "courier_id",
        "stop_order",
        "zone",
        "distance_from_previous_km",
        "estimated_minutes",
        "accumulated_km",
    )
    orders = data.orders.select("order_id", "restaurant_id", "created_at", "status", "zone")
    places = delivery_locations(routes) if locations is None else locations
    return Nodes(
        users=one_per_key(data.users.select("user_id", "name", "zone"), "user_id"),
        products=one_per_key(
            data.products.select("product_id", "name", "category", "price"), "product_id"
        ),
        orders=one_per_key(orders, "order_id", ["created_at"]),
        locations=one_per_key(places, "location_id"),
        couriers=routes.select("courier_id").distinct(),
        stops=one_per_key(stops, ("courier_id", "stop_order")),
    )


def placed(data: Tables) -> DataFrame:
    pairs = data.orders.select("user_id", "order_id").distinct()
    return _between_known(pairs, {"user_id": (data.users, "user_id")})


def contains(data: Tables) -> DataFrame:
    """One edge per order and product; lines of the same product are summed."""
    edges = data.order_items.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("quantity"),
        F.max("unit_price").alias("unit_price"),
        money_sum(line_amount(F.col("quantity"), F.col("unit_price"))).alias("line_total"),
    )
    ends = {
        "order_id": (data.orders, "order_id"),
        "product_id": (data.products, "product_id"),
    }
    return _between_known(edges, ends)


def recommends(data: Tables) -> DataFrame:
    ends = {
        "from_user_id": (data.users, "user_id"),
        "to_user_id": (data.users, "user_id"),
    }
    return _between_known(recommendations(data.users).distinct(), ends)


def bought_together(data: Tables) -> DataFrame:
    """Pairs of known products: unknown ones leave before pairs are made."""
    known = data.order_items.join(data.products.select("product_id"), "product_id", "left_semi")
    return co_purchases(known).withColumnRenamed("times_bought_together", "times")


def delivers_to(data: Tables, routes: DataFrame, locations: DataFrame | None = None) -> DataFrame:
    pairs = routes.select("order_id", "location_id").distinct()
    ends = {"order_id": (data.orders, "order_id")}
    if locations is not None:
        ends["location_id"] = (locations, "location_id")
    return _between_known(pairs, ends)


def has_stop(data: Tables, routes: DataFrame) -> DataFrame:
    known = _between_known(routes, {"order_id": (data.orders, "order_id")})
    return known.select("courier_id", "stop_order").distinct()


def delivers_order(data: Tables, routes: DataFrame) -> DataFrame:
    known = _between_known(routes, {"order_id": (data.orders, "order_id")})
    return known.select("courier_id", "stop_order", "order_id").distinct()


def build_edges(
    data: Tables,
    routes: DataFrame,
    locations: DataFrame | None = None,
    legs: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> Edges:
    """Edges between known nodes, one per key.

    Own routes name the places they lead to. Tables that come from elsewhere
    (``locations``, ``legs``, counted ``pairs``) are matched at all their ends.
    """
    route_to = route_edges(routes) if legs is None else legs
    if locations is not None:
        ends = {f"{side}_location_id": (locations, "location_id") for side in ("from", "to")}
        route_to = _between_known(route_to, ends)
    if pairs is None:
        together = bought_together(data)
    else:
        ends = {f"product_{side}_id": (data.products, "product_id") for side in "ab"}
        together = _between_known(pairs.withColumnRenamed("times_bought_together", "times"), ends)
    return Edges(
        placed=placed(data),
        contains=contains(data),
        recommends=recommends(data),
        bought_together=one_per_key(together, ("product_a_id", "product_b_id")),
        has_stop=has_stop(data, routes),
        delivers_order=delivers_order(data, routes),
        delivers_to=delivers_to(data, routes, locations),
        route_to=one_per_key(route_to, EDGE_KEYS["route_to"]),
    )


def from_files(files: Mapping[str, DataFrame]) -> tuple[Nodes, Edges]:
    """The graph of the nine exchange files, with the ends of every edge matched."""
    users = files["users"]
    referred = files["recommendations"]
    data = Tables(
        users=users.withColumn("referred_by", F.lit(None).cast("string")),
        products=files["products"],
        orders=files["orders"],
        order_items=files["order_items"],
    )
    routes, places = files["route_assignments"], files["locations"]
    nodes = build_nodes(data, routes, places)
    edges = build_edges(data, routes, places, files["route_edges"], files["co_purchases"])
    ends = {f"{side}_user_id": (users, "user_id") for side in ("from", "to")}
    return nodes, replace(edges, recommends=_between_known(referred.distinct(), ends))


# Questions ----------------------------------------------------------------


def influential_users(data: Tables) -> DataFrame:
    """Who referred whom, with the number of users each referred.

    One row per referrer and referred user, at every size.
    """
    edges = recommends(data)
    users = data.users.select("user_id", "name")
    counts = edges.groupBy("from_user_id").agg(F.count(F.lit(1)).alias("usuarios_recomendados"))
    who = counts.join(users.withColumnsRenamed({"user_id": "from_user_id", "name": "usuario"}), "from_user_id")
    whom = users.withColumnsRenamed({"user_id": "to_user_id", "name": "recomendado"})
    return (
        edges.join(who, "from_user_id")
        .join(whom, "to_user_id")
        .select(
            F.col("from_user_id").alias("usuario_id"),
            "usuario",
            "usuarios_recomendados",
            F.col("to_user_id").alias("recomendado_id"),
            "recomendado",
        )
        .orderBy(F.desc("usuarios_recomendados"), "usuario", "usuario_id", "recomendado", "recomendado_id")
    )


def active_users(data: Tables, k: int = 10) -> DataFrame:
    """The k users with most orders; counted before they are named."""
    counts = placed(data).groupBy("user_id").agg(F.count(F.lit(1)).alias("pedidos_realizados"))
    names = one_per_key(data.users.select("user_id", "name"), "user_id")
    return (
        counts.join(names, "user_id")
        .select(
            F.col("user_id").alias("usuario_id"),
            F.col("name").alias("usuario"),
            "pedidos_realizados",
        )
        .orderBy(F.desc("pedidos_realizados"), "usuario", "usuario_id")
        .limit(k)
    )


def category_units(data: Tables) -> DataFrame:
    """Units and revenue per category over the order contents, all statuses."""
    per_product = (
        contains(data)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("quantity"), F.sum("line_total").alias("line_total"))
    )
    categories = one_per_key(data.products.select("product_id", "category"), "product_id")
    return (
        per_product.join(categories, "product_id")
        .groupBy(F.col("category").alias("categoria"))
        .agg(F.sum("quantity").alias("unidades"), money_sum("line_total").alias("ingresos"))
        .orderBy(F.desc("ingresos"), "categoria")
    )


def route_stops(data: Tables, routes: DataFrame) -> DataFrame:
    """Stops per courier in driving order: courier, stop, order, location."""
    return (
        _between_known(routes, {"order_id": (data.orders, "order_id")})
        .select(
            F.col("courier_id").alias("repartidor"),
            F.col("stop_order").alias("parada"),
            F.col("order_id").alias("pedido"),
            F.concat(F.lit(DELIVERY_NAME_PREFIX), "order_id").alias("ubicacion"),
            F.col("zone").alias("zona"),
            F.col("distance_from_previous_km").alias("distancia_desde_anterior_km"),
            F.col("estimated_minutes").alias("tiempo_estimado_min"),
            F.col("accumulated_km").alias("distancia_acumulada_km"),
        )
        .orderBy("repartidor", "parada")
    )


def courier_workload(routes: DataFrame) -> DataFrame:
    """Stops, km and minutes per courier: sums of the rounded legs."""

    def exact(name: str, scale: int):
        total = F.sum(F.col(name).cast(f"decimal(18,{scale})"))
        return total.cast("double")

    return (
        routes.groupBy(F.col("courier_id").alias("repartidor"))
        .agg(
            F.count(F.lit(1)).alias("pedidos_asignados"),
            exact("distance_from_previous_km", 3).alias("distancia_total_km"),
            exact("estimated_minutes", 2).alias("tiempo_total_min"),
        )
        .orderBy("repartidor")
    )


def route_legs(edges: DataFrame, locations: DataFrame) -> DataFrame:
    """Legs by the names of their ends."""

    def named(side: str, name: str) -> DataFrame:
        return locations.select(
            F.col("location_id").alias(f"{side}_location_id"), F.col("name").alias(name)
        )

    return (
        edges.join(named("from", "desde"), "from_location_id")
        .join(named("to", "hacia"), "to_location_id")
        .select(
            F.col("courier_id").alias("repartidor"),
            F.col("stop_order").alias("parada"),
            "desde",
            "hacia",
            F.col("distance_from_previous_km").alias("distancia_km"),
            F.col("estimated_minutes").alias("tiempo_min"),
        )
        .orderBy("repartidor", "parada")
    )


# Bounded samples for drawing; the first rows in key order -----------------


def _first(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)


def sample_purchases(data: Tables, k: int = 50) -> DataFrame:
    keys = ("user_id", "order_id", "product_id")
    content = contains(data).select("order_id", "product_id")
    return _first(placed(data).join(content, "order_id").select(*keys), k, *keys)


def sample_bought_together(data: Tables, k: int = 30) -> DataFrame:
    order = (F.desc("times"), "product_a_id", "product_b_id")
    return _first(bought_together(data), k, *order)


def sample_recommendations(data: Tables, k: int = 30) -> DataFrame:
    return _first(recommends(data), k, "from_user_id", "to_user_id")


def sample_deliveries(data: Tables, routes: DataFrame, k: int = 50) -> DataFrame:
    return _first(delivers_to(data, routes), k, "order_id", "location_id")


def sample_stops(data: Tables, routes: DataFrame, k: int = 60) -> DataFrame:
    return _first(route_stops(data, routes), k, "repartidor", "parada")


def sample_legs(edges: DataFrame, locations: DataFrame, k: int = 60) -> DataFrame:
    return _first(route_legs(edges, locations), k, "repartidor", "parada")


# Checks -------------------------------------------------------------------


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas")).where(F.col("filas") > 1)


def uniqueness_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated keys of all node tables, as (label, key as a JSON list, rows)."""
    found = [
        duplicate_keys(df, *NODE_KEYS[label]).select(
            F.lit(label).alias("etiqueta"),
            F.to_json(F.array(*[F.col(c).cast("string") for c in NODE_KEYS[label]])).alias("clave"),
            "filas",
        )
        for label, df in tables.items()
    ]
    report = found[0]
    for more in found[1:]:
        report = report.unionByName(more)
    return report
