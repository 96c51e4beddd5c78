"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads, BENCH_RUNS the
timed runs per query, of which the median counts. Each query is first run on
the smallest tables, so that no timing holds the start of the JVM. Names given
as arguments are timed instead of the headline; ``all`` times every query.
``stored_*`` are views over the star that ``stored_load`` wrote as ORC tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from comanda.operators import olap  # noqa: E402
from comanda.operators.star import read_star  # noqa: E402
from comanda.plans import nightly  # noqa: E402
from comanda.queries import QUERIES  # noqa: E402
from comanda.session import prepare, remove_run_folders  # noqa: E402
from comanda.sources import retail  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "dim_tiempo",
    "dim_usuario",
    "dim_producto",
    "fact_items_pedido",
    "fact_reservaciones",
    "revenue_by_month_category",
    "user_activity_by_restaurant",
    "order_status_mix",
    "consumption_ranking",
    "peak_hours_weekday",
    "monthly_growth",
    "card_average_ticket",
    "card_unique_users",
    "best_sellers",
    "activity_per_user",
    "reservations_by_restaurant",
    "fact_sales",
    "daily_trend",
    "peak_hours",
    "monthly_growth_flat",
    "reservations_summary",
    "co_purchases",
    "top_bought_together",
    "influential_users",
    "active_users",
    "category_units_graph",
    "graph_contains",
    "courier_queue",
    "route_assignments",
    "courier_workload",
    "shortest_paths_from_depot",
    "dangling_keys",
    "catalogue_changes",
    "upsert_products",
)


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return prepare(spark)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median_low(seconds), 3)


def main() -> None:
    named = sys.argv[1:] or list(HEADLINE)
    spark = session(tempfile.mkdtemp(prefix="comanda-bench-"))
    warm = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.001")
    chosen = {name: q for name, q in QUERIES.items() if name in named or named == ["all"]}
    if os.path.isdir(warm):
        for query in chosen.values():
            run(query(spark, warm))
    times = {name: timed(lambda: run(query(spark, FOLDER))) for name, query in chosen.items()}

    if not sys.argv[1:]:
        source = retail.read(spark, FOLDER)
        start = time.perf_counter()
        nightly.load_star(spark, source, "bench_dw")
        times["stored_load"] = round(time.perf_counter() - start, 3)
        star = read_star(spark, "bench_dw")
        for name, view in olap.VIEWS.items():
            times[f"stored_{name}"] = timed(lambda: run(view(star)))

    print(
        json.dumps(
            {
                "metric": "headline queries, median seconds each, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )
    remove_run_folders()
    spark.stop()


if __name__ == "__main__":
    main()
