"""The analytics job: sales analyses, routes and the graph exchange files."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from comanda.constants import DEPOT_LATITUDE, DEPOT_LONGITUDE, STOPS_PER_COURIER
from comanda.operators import sales
from comanda.operators.basket import co_purchases, most_frequent_first
from comanda.operators.routing import route_assignments
from comanda.plans.arguments import add_source, read_source
from comanda.session import materialise, prepare, remove_run_folders
from comanda.sinks.files import export_graph, write_results
from comanda.sinks.warehouse import ANALYSIS, write_tables
from comanda.sources.normalise import normalise
from comanda.sources.tables import Tables


@dataclass(frozen=True)
class AnalysisOptions:
    """``couriers`` asks for a fixed fleet instead of one that grows with the orders."""

    couriers: int | None = None
    stops_per_courier: int = STOPS_PER_COURIER
    depot: tuple[float, float] = (DEPOT_LATITUDE, DEPOT_LONGITUDE)
    database: str | None = None


def analyses(data: Tables) -> dict[str, DataFrame]:
    """The results of the job over normalised tables, by table name."""
    return {
        "fact_sales": sales.fact_sales(data),
        "consumption_trends": sales.consumption_trends(data),
        "peak_hours": sales.peak_hours(data),
        "monthly_growth": sales.monthly_growth(data),
        "reservations_summary": sales.reservations_summary(data.reservations),
        "co_purchases": co_purchases(data.order_items),
    }


def run(
    spark: SparkSession,
    source: Tables,
    results_folder: str,
    graph_folder: str,
    options: AnalysisOptions = AnalysisOptions(),
) -> None:
    """Write every analysis as CSV, the graph files, and, if asked, tables.

    Orders and items are joined once and written down, as are routes, product
    pairs, and results that go to two places.
    """
    prepare(spark)
    shaped = normalise(source)
    lines = materialise(sales.order_lines(shaped), "order_lines")
    data = Tables(**dict(shaped.items()), order_lines=lines)
    results = analyses(data)
    pairs = materialise(results["co_purchases"], "co_purchases")
    results["co_purchases"] = pairs
    if options.database:
        results = {n: pairs if df is pairs else materialise(df, n) for n, df in results.items()}
    routes = materialise(
        route_assignments(
            data.orders, options.couriers, options.stops_per_courier, options.depot
        ),
        "routes",
    )
    shown = {**results, "co_purchases": most_frequent_first(pairs), "route_assignments": routes}
    write_results(shown, results_folder)
    export_graph(data, pairs, routes, graph_folder, options.depot)
    if options.database:
        write_tables({**results, "route_assignments": routes}, options.database, ANALYSIS)


def register_views(data: Tables) -> None:
    """Offer the flat fact and the reservations to ``spark.sql``."""
    sales.fact_sales(data).createOrReplaceTempView("fact_sales")
    data.reservations.createOrReplaceTempView("reservations")


def main(arguments: Sequence[str] | None = None) -> None:
    """Run the job from a command line, e.g. through ``spark-submit``."""
    parser = argparse.ArgumentParser(description="Sales analyses, routes and graph files")
    add_source(parser)
    parser.add_argument("--results", required=True, help="folder of the result CSVs")
    parser.add_argument("--graph", required=True, help="folder of the graph exchange CSVs")
    parser.add_argument("--database", help="also write tables there")
    parser.add_argument("--couriers", type=int, help="a fixed fleet; its tours grow")
    parser.add_argument("--stops-per-courier", type=int, default=STOPS_PER_COURIER)
    parser.add_argument("--center-lat", type=float, default=DEPOT_LATITUDE)
    parser.add_argument("--center-lon", type=float, default=DEPOT_LONGITUDE)
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("comanda analysis").getOrCreate()
    options = AnalysisOptions(
        couriers=args.couriers,
        stops_per_courier=args.stops_per_courier,
        depot=(args.center_lat, args.center_lon),
        database=args.database,
    )
    run(spark, read_source(spark, args), args.results, args.graph, options)
    remove_run_folders()


if __name__ == "__main__":
    main()
