"""Every query as a function of a session and a folder of wholesale tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.constants import SOLD_IN_STAR
from comanda.operators import basket, graph, olap, paths, quality, routing, sales, star
from comanda.operators.star import Star
from comanda.plans import nightly
from comanda.schemas import GRAPH_FILES
from comanda.session import materialise, prepare, run_folder
from comanda.sinks import files
from comanda.sources import extracts, retail
from comanda.sources.normalise import normalise
from comanda.sources.tables import Tables, read_csv

Query = Callable[[SparkSession, str], DataFrame]


def _source(spark: SparkSession, folder: str, statuses: Sequence[str] | None = None) -> Tables:
    return retail.read(prepare(spark), folder, statuses)


def _on_star(
    view: Callable[[Star], DataFrame], statuses: Sequence[str] | None = None
) -> Query:
    """Views join the dimensions themselves, on natural ids.

    ``statuses`` are the orders that the view keeps, where it does not keep all.
    """

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return view(star.build_star(_source(spark, folder, statuses), resolve=False))

    return query


def _on_sold(view: Callable[[Star], DataFrame]) -> Query:
    return _on_star(view, SOLD_IN_STAR)


def _on_source(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(_source(spark, folder))


def _on_data(
    build: Callable[[Tables], DataFrame], statuses: Sequence[str] | None = None
) -> Query:
    return lambda spark, folder: build(normalise(_source(spark, folder, statuses)))


def _routes(data: Tables) -> DataFrame:
    return routing.route_assignments(data.orders)


def _on_routes(build: Callable[[Tables, DataFrame], DataFrame]) -> Query:
    """Tours are computed once and written, as several steps read them."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        data = normalise(_source(spark, folder))
        return build(data, materialise(_routes(data), "routes"))

    return query


def _fact_items(source: Tables) -> DataFrame:
    """The items fact with the ids of its known members."""
    fact = star.fact_items_pedido(
        source.orders, source.order_items, star.build_star(source), natural=True
    )
    return fact.drop("usuario_key", "restaurante_key", "producto_key")


def _fact_reservations(source: Tables) -> DataFrame:
    fact = star.fact_reservaciones(source.reservations, star.build_star(source), natural=True)
    return fact.drop("usuario_key", "restaurante_key")


def _table_counts(source: Tables) -> DataFrame:
    built = star.build_star(source, resolve=False)
    return quality.row_counts(
        {name: getattr(built, name) for name in Star.NAMES}
    )


def _perturbed(products: DataFrame) -> DataFrame:
    """A later catalogue: some products gone, dearer, renamed, sold out or new."""
    products = products.withColumn("id", F.col("id").cast("string"))
    rest = F.col("id").cast("bigint") % 17
    moved = products.where(rest != 0).withColumns(
        {
            "price": F.when(rest == 1, F.col("price") + 1)
            .otherwise(F.col("price"))
            .cast("decimal(18,2)"),
            "name": F.when(rest == 2, F.concat("name", F.lit(" nuevo"))).otherwise(F.col("name")),
            "available": F.when(rest == 3, F.lit(None)).otherwise(F.col("available")),
        }
    )
    added = products.where(rest == 4).withColumn("id", F.concat(F.lit("n"), "id"))
    return moved.unionByName(added)


def _upsert(source: Tables) -> DataFrame:
    columns = [F.col("id").cast("string").alias("id"), "name", "category", "price"]
    products = source.products.select(*columns)
    later = _perturbed(source.products).select(*columns)
    return graph.upsert(products, later, "id")


def _monthly_users(built: Star) -> DataFrame:
    """The monthly table, written as a load would keep it."""
    return materialise(olap.monthly_users(built), "monthly_users")


def _duplicates(data: Tables) -> DataFrame:
    """Repeated (order, product) lines, which edges must be merged over."""
    return graph.duplicate_keys(data.order_items, "order_id", "product_id")


def _node_violations(data: Tables, routes: DataFrame) -> DataFrame:
    """Keys repeated in node tables of which some rows come twice."""

    def twice(df: DataFrame, key: str, every: int) -> DataFrame:
        number = F.regexp_extract(F.col(key), "[0-9]+$", 0).try_cast("bigint")
        return df.unionByName(df.where(number % every == 0))

    couriers = routes.select("courier_id").distinct()
    stops = routes.select("courier_id", "stop_order")
    return graph.uniqueness_violations(
        {
            "users": twice(data.users, "user_id", 5),
            "products": twice(data.products, "product_id", 7),
            "orders": twice(data.orders, "order_id", 11),
            "locations": twice(graph.delivery_locations(routes), "location_id", 13),
            "couriers": twice(couriers, "courier_id", 3),
            "stops": twice(stops, "courier_id", 4),
        }
    )


def _node(name: str) -> Callable[[Tables, DataFrame], DataFrame]:
    def build(data: Tables, routes: DataFrame) -> DataFrame:
        found = getattr(graph.build_nodes(data, routes), name)
        if "created_at" in found.columns:
            found = found.withColumn("created_at", _text("created_at"))
        return found

    return build


def _edge(name: str) -> Callable[[Tables, DataFrame], DataFrame]:
    return lambda data, routes: getattr(graph.build_edges(data, routes), name)


def _nearest(data: Tables, routes: DataFrame) -> DataFrame:
    edges = materialise(routing.route_edges(routes), "route_edges")
    found = paths.nearest_destinations(edges, graph.delivery_locations(routes))
    return found.withColumn("ruta", F.concat_ws(" > ", "ruta"))


def _sample_paths(data: Tables, routes: DataFrame) -> DataFrame:
    return paths.sample_paths(materialise(routing.route_edges(routes), "route_edges"))


def _text(column: str):
    """A time as text, which has the same form everywhere."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _extract(name: str, *times: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = extracts.extract(_source(spark, folder), name)
        return found.withColumns({c: _text(c) for c in times})

    return query


# Stars that this process has loaded, by application and folder of tables.
_loaded: dict[tuple[str, str], str] = {}


def _on_warehouse(view: Callable[[Star], DataFrame]) -> Query:
    """Views over the stored star, which is loaded once, into the application's own folder."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        source = _source(spark, folder)
        key = (spark.sparkContext.applicationId, folder)
        if key not in _loaded:
            database = f"comanda_{uuid.uuid4().hex[:12]}"
            spark.sql(f"CREATE DATABASE {database} LOCATION '{run_folder(spark)}/{database}'")
            nightly.load_star(spark, source, database)
            _loaded[key] = database
        return view(star.read_star(spark, _loaded[key]))

    return query


def _exchanged(name: str) -> Callable[[Tables, DataFrame], DataFrame]:
    """An exchange file of the graph, written and read again."""

    def build(data: Tables, routes: DataFrame) -> DataFrame:
        spark = routes.sparkSession
        folder = f"{run_folder(spark)}/exchange-{name}-{uuid.uuid4().hex}"
        table = files.graph_tables(data, basket.co_purchases(data.order_items), routes)[name]
        files.write_csv(table, folder)
        return read_csv(spark, folder, GRAPH_FILES[name])

    return build


QUERIES: dict[str, Query] = {
    # Star: dimensions and facts.
    "dim_tiempo": _on_source(lambda s: star.dim_tiempo(s.orders, s.reservations)),
    "dim_usuario": _on_source(lambda s: star.dim_usuario(s.users).drop("usuario_key")),
    "dim_restaurante": _on_source(
        lambda s: star.dim_restaurante(s.restaurants).drop("restaurante_key")
    ),
    "dim_producto": _on_source(lambda s: star.dim_producto(s.products).drop("producto_key")),
    "fact_items_pedido": _on_source(_fact_items),
    "fact_reservaciones": _on_source(_fact_reservations),
    # Views over the star.
    "revenue_by_month_category": _on_sold(olap.revenue_by_month_category),
    "user_activity_by_restaurant": _on_sold(olap.user_activity_by_restaurant),
    "order_status_mix": _on_star(olap.order_status_mix),
    "consumption_ranking": _on_sold(olap.consumption_ranking),
    "top_product_per_category": _on_sold(olap.top_product_per_category),
    "peak_hours_weekday": _on_sold(olap.peak_hours_weekday),
    "busiest_slots": _on_sold(olap.busiest_slots),
    "monthly_growth": _on_sold(olap.monthly_growth),
    # The same over the star as a load stores it.
    **{
        f"warehouse_{view.__name__}": _on_warehouse(view)
        for view in (
            olap.revenue_by_month_category, olap.user_activity_by_restaurant, olap.order_status_mix,
            olap.consumption_ranking, olap.peak_hours_weekday, olap.monthly_growth,
            olap.reservations_by_restaurant,
        )
    },
    # Dashboard cards.
    "card_revenue_by_month_category": _on_sold(olap.card_revenue_by_month_category),
    "card_average_ticket": _on_sold(olap.card_average_ticket),
    "card_unique_users": _on_sold(olap.card_unique_users),
    "card_monthly_activity": _on_sold(olap.card_monthly_activity),
    "card_orders_per_status": _on_star(olap.card_orders_per_status),
    "card_status_by_month": _on_star(olap.card_status_by_month),
    "exact_average_ticket": _on_sold(olap.exact_average_ticket),
    "exact_unique_users": _on_sold(olap.exact_unique_users),
    "unique_users_rolled_up": _on_sold(
        lambda s: olap.users_rolled_up(_monthly_users(s), "restaurante", "zona")
    ),
    "unique_users_per_year": _on_sold(lambda s: olap.users_rolled_up(_monthly_users(s), "anio")),
    # Ad-hoc questions.
    "revenue_per_restaurant": _on_star(olap.revenue_per_restaurant),
    "orders_per_month": _on_star(olap.orders_per_month),
    "total_revenue": _on_sold(olap.total_revenue),
    "best_sellers": _on_sold(olap.best_sellers),
    "sales_by_hour": _on_sold(olap.sales_by_hour),
    "pickup_vs_delivery": _on_star(olap.pickup_vs_delivery),
    "activity_per_user": _on_star(olap.activity_per_user),
    "daily_orders": _on_star(olap.daily_orders),
    "reservations_by_restaurant": _on_star(olap.reservations_by_restaurant),
    "reservations_by_group_size": _on_star(olap.reservations_by_group_size),
    "reservations_by_status": _on_star(olap.reservations_by_status),
    # Flat sales fact.
    "fact_sales": _on_data(
        lambda d: sales.fact_sales(d).withColumn("created_at", _text("created_at"))
    ),
    "daily_trend": _on_data(lambda d: sales.consumption_trends(d, SOLD_IN_STAR), SOLD_IN_STAR),
    "peak_hours": _on_data(lambda d: sales.peak_hours(d, SOLD_IN_STAR), SOLD_IN_STAR),
    "monthly_growth_flat": _on_data(lambda d: sales.monthly_growth(d, SOLD_IN_STAR), SOLD_IN_STAR),
    "reservations_summary": _on_data(lambda d: sales.reservations_summary(d.reservations)),
    # Products bought together.
    "co_purchases": _on_data(
        lambda d: basket.most_frequent_first(basket.co_purchases(d.order_items))
    ),
    "top_bought_together": _on_data(
        lambda d: basket.top_bought_together(d.order_items, d.products)
    ),
    # Graph.
    "influential_users": _on_data(graph.influential_users),
    "active_users": _on_data(graph.active_users),
    "category_units_graph": _on_data(graph.category_units),
    "graph_placed": _on_data(graph.placed),
    "graph_contains": _on_data(graph.contains),
    "graph_recommends": _on_data(graph.recommends),
    **{f"graph_node_{name}": _on_routes(_node(name)) for name in graph.NODE_KEYS},
    **{
        f"graph_edge_{name}": _on_routes(_edge(name))
        for name in ("bought_together", "has_stop", "delivers_order", "delivers_to", "route_to")
    },
    "graph_sample_purchases": _on_data(graph.sample_purchases),
    "graph_sample_bought_together": _on_data(graph.sample_bought_together),
    "graph_sample_recommendations": _on_data(graph.sample_recommendations),
    "graph_sample_deliveries": _on_routes(graph.sample_deliveries),
    "graph_sample_stops": _on_routes(graph.sample_stops),
    "graph_sample_legs": _on_routes(
        lambda d, r: graph.sample_legs(routing.route_edges(r), graph.delivery_locations(r))
    ),
    "graph_sample_paths": _on_routes(_sample_paths),
    **{f"exchange_{name}": _on_routes(_exchanged(name)) for name in GRAPH_FILES},
    # Routes.
    "courier_queue": _on_data(
        lambda d: routing.assign_couriers(d.orders).select("order_id", "ordinal", "courier")
    ),
    "depot_distances": _on_data(lambda d: routing.depot_distances(d.orders)),
    "shift_queue": _on_data(
        lambda d: routing.assign_shift_couriers(d.orders).select("order_id", "shift", "ordinal", "courier")
    ),
    "shift_assignments": _on_data(lambda d: routing.shift_assignments(d.orders)),
    "route_assignments": _on_data(_routes),
    "route_edges": _on_data(lambda d: routing.route_edges(_routes(d))),
    "route_stops": _on_data(lambda d: graph.route_stops(d, _routes(d))),
    "courier_workload": _on_data(lambda d: graph.courier_workload(_routes(d))),
    "courier_assignments": _on_data(lambda d: routing.courier_orders(_routes(d))),
    "route_legs": _on_routes(
        lambda d, r: graph.route_legs(routing.route_edges(r), graph.delivery_locations(r))
    ),
    "delivery_locations": _on_data(lambda d: graph.delivery_locations(_routes(d))),
    "shortest_paths_from_depot": _on_routes(_nearest),
    # Quality, differences, extracts.
    "row_counts": _on_source(_table_counts),
    "dangling_keys": _on_source(lambda s: quality.dangling_keys(star.build_star(s))),
    "repeated_lines": _on_data(_duplicates),
    "uniqueness_violations": _on_routes(_node_violations),
    "catalogue_changes": _on_source(
        lambda s: quality.catalogue_changes(s.products, _perturbed(s.products))
    ),
    "catalogue_fingerprint": _on_source(lambda s: quality.fingerprint(s.products)),
    "upsert_products": _on_source(_upsert),
    "extract_orders_with_items": _extract("orders_with_items", "order_created_at"),
    "extract_reservations": _extract("reservations", "date", "created_at"),
    "extract_users": _extract("users", "fecha_registro"),
    "extract_restaurants": _extract("restaurants"),
    "extract_products": _extract("products"),
}
