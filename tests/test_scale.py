"""Hot keys, partition counts and plans."""

import itertools
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from compare import connect, differences
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.constants import ROUTABLE_STATUSES
from comanda.oracles import ORACLES
from comanda.queries import QUERIES
from comanda.operators import basket, graph, olap, paths, routing, sales, star
from comanda.operators.ordinal import with_group_ordinal, with_ordinal
from comanda.operators.ranking import rank_within
from comanda.sources.normalise import normalise
from comanda.sources import retail
from comanda.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def brute_pairs(lines):
    baskets = {}
    for order, product in lines:
        baskets.setdefault(order, set()).add(product)
    return Counter(
        pair for b in baskets.values() for pair in itertools.combinations(sorted(b), 2)
    )


def test_pairs_of_a_hot_order(spark):
    """One order holds a third of all lines, many of them repeated."""
    draw = random.Random(7)
    lines = [("hot", f"p{draw.randrange(150):03d}") for _ in range(700)]
    lines += [(f"o{draw.randrange(400)}", f"p{draw.randrange(200):03d}") for _ in range(1400)]
    items = spark.createDataFrame(lines, "order_id string, product_id string").repartition(6)
    found = {(a, b): n for a, b, n in rows(basket.co_purchases(items))}
    assert found == dict(brute_pairs(lines))


def test_large_orders_are_paired_by_many_tasks(spark):
    """The join splits the lines of one long order, although its rows share a key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        lines = [("hot", f"p{i:04d}") for i in range(600)]
        lines += [(f"o{i}", f"p{i % 7:04d}") for i in range(600)]
        items = spark.createDataFrame(lines, "order_id string, product_id string").repartition(8)
        pairs = basket.co_purchases(items)
        assert len(pairs.collect()) == 600 * 599 // 2
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "CartesianProduct" not in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_rank_of_a_hot_group(spark):
    draw = random.Random(3)
    data = [("hot", draw.randrange(20), i) for i in range(600)]
    data += [(f"g{draw.randrange(40)}", draw.randrange(20), i) for i in range(600, 1800)]
    data += [(None, 5, 1800), (None, 7, 1801), ("g1", None, 1802)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    wanted = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    assert sorted(rows(rank_within(df, ["g"], "v", "r")), key=repr) == sorted(
        rows(wanted.withColumn("r", F.col("r").cast("bigint"))), key=repr
    )


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_ordinal_with_a_hot_timestamp(spark, partitions):
    draw = random.Random(5)
    data = [(1 if i % 3 == 0 else draw.randrange(50), f"o{i}") for i in range(900)]
    df = spark.createDataFrame(data, "t int, id string").repartition(partitions)
    wanted = sorted(data)
    found = sorted(rows(with_ordinal(df, ["t", "id"])), key=lambda r: r[2])
    assert [(t, i) for t, i, _ in found] == wanted
    assert [n for _, _, n in found] == list(range(900))


def test_group_ordinal_with_a_hot_group(spark):
    data = [("hot" if i % 3 == 0 else f"g{i % 11}", f"x{i:04d}") for i in range(600)]
    df = spark.createDataFrame(data, "g string, x string").repartition(5)
    found = rows(with_group_ordinal(df, ["g"], ["x"], "n"))
    groups = {}
    for g, x in sorted(data):
        groups.setdefault(g, []).append(x)
    assert {(g, x): n for g, x, n in found} == {
        (g, x): n for g, xs in groups.items() for n, x in enumerate(xs)
    }


def test_a_hot_referrer_has_a_row_per_referred_user(spark):
    users = [("u0", "Jefe", None)]
    users += [(f"u{i}", f"N{i:04d}", "u0" if i % 3 else "u1") for i in range(1, 400)]
    users.append(("x", "Huérfano", "nadie"))
    data = Tables(users=spark.createDataFrame(users, "user_id string, name string, referred_by string"))
    found = [r for r in rows(graph.influential_users(data)) if r[0] == "u0"]
    assert {r[2] for r in found} == {266}
    names = [r[4] for r in found]
    assert names == sorted(n for _, n, by in users if by == "u0")


def test_hot_order_is_split_by_the_join(spark):
    """AQE splits the items of one order although an aggregate follows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        items = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("order_id"),
            F.xxhash64("id").cast("string").alias("product_id"),
            (F.xxhash64("id") % 2 * 0 + 1).cast("int").alias("quantity"),
            (F.abs(F.xxhash64("id")) % 99999).cast("decimal(18,2)").alias("unit_price"),
        ).repartition(16)
        orders = spark.range(60000).select(
            F.col("id").cast("string").alias("order_id"),
            F.lit("u").alias("user_id"), F.lit("r").alias("restaurant_id"),
            F.timestamp_seconds(F.col("id") * 600).alias("created_at"),
            F.lit("completed").alias("status"), F.lit("z").alias("zone"),
            F.lit(1.0).alias("delivery_latitude"), F.lit(1.0).alias("delivery_longitude"),
        )
        data = Tables(orders=orders, order_items=items)
        found = sales.peak_hours(data)
        total = sum(r["units_sold"] for r in found.collect())
        assert total == 60000
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_results_do_not_depend_on_partitions(spark, operational_sample):
    def build(n):
        parts = {name: df.repartition(n) for name, df in operational_sample.items()}
        return star.build_star(Tables(**parts), resolve=False)

    views = [
        sorted(rows(olap.revenue_by_month_category(build(n), ("completed",)))) for n in (1, 4, 33)
    ]
    assert views[0] == views[1] == views[2]


def brute_paths(edges, start, hops):
    by_source = {}
    for edge in edges:
        by_source.setdefault(edge[2], []).append(edge)
    found, frontier = [], [(0.0, 0.0, (start,), ())]
    for _ in range(hops):
        frontier = [
            (km + e[4], minutes + e[5], nodes + (e[3],), used + (e,))
            for km, minutes, nodes, used in frontier
            for e in by_source.get(nodes[-1], [])
            if e not in used
        ]
        found += frontier
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pruned_paths_equal_all_paths(spark, seed):
    """Branching edges with cycles, self loops and parallel edges."""
    draw = random.Random(seed)
    names = ["loc-central"] + [f"n{i}" for i in range(7)]
    edges = [
        (f"c{i % 4}", i, draw.choice(names), draw.choice(names),
         float(draw.choice([0, 1, 1, 2, 5])), float(draw.randrange(4)))
        for i in range(16)
    ] + [("c9", 99, "loc-central", "n0", 1.0, 1.0)]
    df = spark.createDataFrame(
        edges,
        "courier_id string, stop_order int, from_location_id string, to_location_id string, "
        "distance_from_previous_km double, estimated_minutes double",
    )
    places = spark.createDataFrame([(n, n.upper()) for n in names], "location_id string, name string")
    every = brute_paths(edges, "loc-central", 5)
    nearest = rows(paths.nearest_destinations(df, places, max_hops=5, k=4))
    ordered = sorted(every, key=lambda p: (p[0], len(p[3]), p[2][-1], p[3]))[:4]
    assert [(r[1], r[2], r[3]) for r in nearest] == [
        ([n.upper() for n in p[2]], p[0], p[1]) for p in ordered
    ]
    first = rows(paths.sample_paths(df, max_hops=5, k=15))
    ordered = sorted(every, key=lambda p: (len(p[3]), p[2], p[3]))[:15]
    assert [r[1] for r in first] == [" > ".join(p[2]) for p in ordered]


@pytest.mark.parametrize("fleet", [{"couriers": 1}, {"couriers": 3}, {"stops_per_courier": 7}])
def test_tours(spark, fleet):
    """A tour visits every order once, always going to the nearest open one."""
    import math

    def km(a, b):
        d_lat, d_lon = math.radians(b[0] - a[0]), math.radians(b[1] - a[1])
        h = math.sin(d_lat / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(
            math.radians(b[0])
        ) * math.sin(d_lon / 2) ** 2
        return 12742.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    data = normalise(retail.read(spark, FOLDER))
    orders = data.orders.limit(150).persist()
    wanted = sorted(
        rows(orders.where(F.col("status").isin(*ROUTABLE_STATUSES)).select(
            "created_at", "order_id", "delivery_latitude", "delivery_longitude"))
    )
    couriers = fleet.get("couriers") or -(-len(wanted) // fleet["stops_per_courier"])
    expected = []
    for courier in range(couriers):
        open_stops, here, stop = wanted[courier::couriers], (9.9326, -84.0796), 0
        while open_stops:
            stop += 1
            best = min(open_stops, key=lambda s: km(here, s[2:]))
            open_stops.remove(best)
            here = best[2:]
            expected.append((f"courier-{courier + 1}", stop, best[1]))
    found = routing.route_assignments(orders, **{"couriers": None, **fleet})
    assert sorted(rows(found.select("courier_id", "stop_order", "order_id"))) == sorted(expected)
    orders.unpersist()


def test_no_raw_rows_in_one_task(spark):
    """Only windows over months or write partitions, and one count per task of a
    whole table, may come together in one task."""
    data = normalise(retail.read(spark, FOLDER))
    built = star.build_star(retail.read(spark, FOLDER), resolve=False)
    for df in (
        olap.revenue_by_month_category(built),
        olap.consumption_ranking(built),
        olap.user_activity_by_restaurant(built),
        basket.co_purchases(data.order_items),
        sales.consumption_trends(data),
        graph.contains(data),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", plan)
        assert all("HashAggregate(keys=[], functions=[partial_" in line for line in below)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_reads_the_lines_once(spark):
    """Rows and counts of the rank share one aggregate, as a query and as a view."""
    built = star.build_star(retail.read(spark, FOLDER), resolve=False)
    olap.register_views(built)
    for df in (olap.consumption_ranking(built), spark.sql("select * from olap_tendencias_consumo")):
        assert any("lineitem" in f for f in df.inputFiles())
        final = executed(df).split("\n+- == Initial Plan ==")[0]
        assert "ReusedExchange" in final
        assert len(re.findall(r"ReadSchema: struct<[^>]*l_quantity", final)) == 1


def test_building_a_query_starts_no_job(spark):
    """But for those that number rows first, look for a bound, or read back what they write."""
    ordered = ("route", "courier", "graph_node", "graph_edge", "graph_sample", "delivery",
               "shortest", "uniqueness", "shift", "unique_users", "top_bought", "warehouse", "exchange")
    tracker = spark.sparkContext.statusTracker()
    for name, query in QUERIES.items():
        if name.startswith(ordered):
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        query(spark, FOLDER)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build-{name}")]
        # Reading a file's schema is a job of its own.
        assert len(jobs) <= 14, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lines_are_shuffled_for_order_and_product_only(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        plan = QUERIES["fact_items_pedido"](spark, FOLDER)._jdf.queryExecution().executedPlan()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    text = plan.toString()
    over_lines = [
        line for line in text.split("\n")
        if "Exchange hashpartitioning" in line and re.search("order_id|l_orderkey|product_id|l_partkey", line)
    ]
    # Orders and lines by order, lines and products by product.
    assert len(over_lines) <= 4
    assert "restaurant_id" not in "".join(over_lines)


def test_lines_are_not_shuffled_for_a_product_table_too_large_to_broadcast(spark):
    """Only keys other than the hash are looked up, and here are none."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "4096",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        plan = QUERIES["fact_items_pedido"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    by_hash = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert by_hash and not re.search("product_id|l_partkey|_own", "".join(by_hash)), by_hash


def test_sold_orders_are_filtered_by_the_scan(spark):
    for name in ("revenue_by_month_category", "best_sellers", "daily_trend", "peak_hours"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: \[[^\]]*o_orderstatus[^\]]*F", plan), name


@pytest.mark.parametrize(
    "name", ["revenue_by_month_category", "consumption_ranking", "influential_users",
             "co_purchases", "graph_contains", "fact_items_pedido"],
)
def test_shuffle_joins_with_skew_splits(spark, name):
    """The plans of large tables: no broadcast by size, every partition split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert found is None


def test_filters_and_columns_reach_the_scan(spark):
    built = star.build_star(retail.read(spark, FOLDER), resolve=False)
    plan = olap.total_revenue(built)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert not any("l_comment" in s or "l_tax" in s for s in scans)
    assert any("l_orderkey" in s and "l_partkey" not in s for s in scans)


def test_library_does_not_collect():
    package = Path(__file__).parent.parent / "comanda"
    for path in package.rglob("*.py"):
        for line in path.read_text().split("\n"):
            # What comes to the driver, or into one task, says what bounds it.
            words = ("toPandas", "crossJoin", "localCheckpoint")
            if "# bounded: " not in line:
                words += (".collect()", "coalesce(1)")
            for word in words:
                assert word not in line, f"{word} in {path}"
