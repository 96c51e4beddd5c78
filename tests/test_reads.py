"""Splits of database reads, rejected lines, shifts, pairs, paths and roll-ups."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.constants import SMALL_FLEET
from comanda.operators import basket, olap, paths, routing, star
from comanda.operators.ordinal import with_ordinal
from comanda.plans import graph_load, nightly
from comanda.session import materialise
from comanda.sinks import files, warehouse
from comanda.sources import tables


def keyed(spark, keys):
    spark.createDataFrame([(k,) for k in keys], "id string").createOrReplaceTempView("claves")
    return spark.table("claves")


@pytest.mark.parametrize("kind", ["spread", "ties", "odd", "one", "none"])
def test_text_ranges_cover_every_row_once(spark, kind):
    draw = random.Random(2)
    keys = {
        "spread": [f"{draw.randrange(10**6):06d}" for _ in range(3000)],
        "ties": ["a"] * 900 + ["b"] * 50 + [f"c{i}" for i in range(50)],
        "odd": ["it's", "back\\slash", "", "ñandú", '"q"', "a%b_c", "Z", "z", "\n"] * 20,
        "one": ["only"] * 30,
        "none": [],
    }[kind] + [None, None]
    table = keyed(spark, keys)
    query = tables.tiles_query("claves", "id", 7, 100, "spark")
    tiles = [r[0] for r in spark.sql(query).collect()]
    assert len(tiles) <= 7
    clauses = tables.range_predicates("id", tiles, "spark")
    parts = [table.where(c) for c in clauses]
    counts = [p.count() for p in parts]
    assert sum(counts) == len(keys)
    found = sorted((r[0] for p in parts for r in p.collect()), key=repr)
    assert found == sorted(keys, key=repr)
    if kind == "spread":
        assert len(clauses) == 7 and max(counts) < 1.2 * min(counts)


def test_range_clauses_can_use_an_index():
    clauses = tables.range_predicates("id", ["a", "d'x", "d'x", "m"])
    assert clauses == [
        "id < 'd''x' OR id IS NULL", "id >= 'd''x' AND id < 'm'", "id >= 'm'",
    ]
    query = tables.tiles_query("orders", "id", 8, 1.0, "postgresql")
    assert "TABLESAMPLE SYSTEM (1.0)" in query and "ntile(8)" in query and query.endswith("ORDER BY 1")


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("d", T.DecimalType(18, 2))])


def test_broken_csv_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,n,d\nx,1,2.50\ny,zwei,1\nz,3\n"q, r",4,5\nw,5,6,7\nv,\\N,8\n')
    read = tables.read_csv_checked(spark, str(tmp_path), SCHEMA, "cosas")
    assert sorted(r.id for r in read.rows.collect()) == ["q, r", "v", "x"]
    bad = read.rejected.collect()
    assert sorted(r.line for r in bad) == ["w,5,6,7", "y,zwei,1", "z,3"]
    assert {r.source for r in bad} == {"cosas"} and all(r.file.endswith("a.csv") for r in bad)


def test_broken_json_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x", "n": 1}\n{"id": "y", "n": "zwei"}\n{"id": \n{"id": "z"}\n')
    read = tables.read_documents_checked(spark, str(tmp_path), SCHEMA, "cosas")
    assert sorted(r.id for r in read.rows.collect()) == ["x", "z"]
    assert read.rejected.count() == 2


def test_a_graph_load_keeps_what_it_rejects(spark, sample_data, tmp_path):
    routes = materialise(routing.route_assignments(sample_data.orders, SMALL_FLEET), "routes")
    files.export_graph(sample_data, basket.co_purchases(sample_data.order_items), routes, str(tmp_path))
    (tmp_path / "products" / "extra.csv").write_text("product_id,name,category,price\np9,Pan,pan,caro\np8,Sal,sal,1.50\n")
    counts = graph_load.load(spark, str(tmp_path), "grafo_roto")
    assert counts[warehouse.REJECTED] == 1 and counts["node_products"] == 7
    kept = spark.table(f"grafo_roto.{warehouse.REJECTED}").collect()
    assert [(r.source, r.line) for r in kept] == [("products", "p9,Pan,pan,caro")]


def test_a_load_reports_what_its_rows_miss(spark, operational_sample, tmp_path):
    given = dict(operational_sample.items())
    given["users"] = given["users"].where("id <> 'u1'")
    source = tables.Tables(**given)
    lines = given["order_items"].join(given["orders"].withColumnRenamed("id", "order_id").where("user_id = 'u1'"), "order_id", "left_semi")
    expected = lines.count()
    assert expected > 0
    report = nightly.run(spark, source, str(tmp_path), "faltas_dw")
    assert report.missing["fact_items_pedido"] == {"usuario_key": expected}
    with pytest.raises(warehouse.LoadRejected, match="usuario_key"):
        nightly.run(spark, source, str(tmp_path), "faltas_dw", {"usuario_key": 0.01})
    before = warehouse.current_load(spark, warehouse.STAR, "faltas_dw")
    nightly.run(spark, source, str(tmp_path), "faltas_dw", {"fact_items_pedido.usuario_key": 0.9, "usuario_key": 0.9})
    assert warehouse.current_load(spark, warehouse.STAR, "faltas_dw") > before


def test_shifts_end_at_gaps_and_tours_stay_inside(spark):
    hours = [0, 1, 3, 3, 6, 30, 31, 100]
    data = [
        (f"o{i}", "u", "completed", 9.9 + i / 100, -84.0, zone, f"2026-01-0{1 + h // 24} {h % 24:02d}:00:00" if h is not None else None)
        for zone in ("norte", "sur") for i, h in enumerate([*hours, None])
    ]
    kinds = "order_id string, user_id string, status string, delivery_latitude double, delivery_longitude double, zone string, at string"
    orders = spark.createDataFrame([(f"{z}{o}", u, s, a, b, z, t) for o, u, s, a, b, z, t in data], kinds)
    orders = orders.withColumn("created_at", F.to_timestamp("at")).drop("at")
    dealt = routing.assign_shift_couriers(orders, "2 hours", 2).collect()
    shifts = {}
    for r in dealt:
        shifts.setdefault(r.shift, []).append((r.ordinal, r.order_id, r.courier))
    sizes = {s: len(v) for s, v in shifts.items()}
    assert sizes == {f"{z} {b}": n for z in ("norte", "sur") for b, n in [
        ("2026-01-01 00:00:00", 4), ("2026-01-01 06:00:00", 1), ("2026-01-02 06:00:00", 2),
        ("2026-01-05 04:00:00", 1), ("sin hora", 1)]}
    assert all(sorted(n for n, _, _ in v) == list(range(len(v))) for v in shifts.values())
    stops = routing.shift_assignments(orders, "2 hours", 2).collect()
    assert len(stops) == len(data)
    own = {r.order_id: (r.shift, f"courier-{r.courier + 1}") for r in dealt}
    assert all(own[s.order_id] == (s.shift, s.courier_id) for s in stops)
    tours = {}
    for s in stops:
        tours.setdefault((s.shift, s.courier_id), []).append(s.stop_order)
    assert all(sorted(t) == list(range(1, len(t) + 1)) and len(t) <= 2 for t in tours.values())


def test_a_bound_on_support_spares_pairs(spark, monkeypatch):
    draw = random.Random(4)
    lines = []
    for order in range(600):
        popular = draw.sample(range(8), 3)
        rare = [f"r{order}-{i}" for i in range(12)]
        lines += [(f"o{order}", f"p{i}") for i in popular] + [(f"o{order}", r) for r in rare]
    items = spark.createDataFrame(lines, "order_id string, product_id string")
    formed, count_pairs = [], basket._pair_counts

    def watched(given):
        counted = count_pairs(given)
        formed.append(counted.agg(F.sum("times_bought_together")).first()[0] or 0)
        return counted

    monkeypatch.setattr(basket, "_pair_counts", watched)
    found = sorted(rows(basket.frequent_pairs(items, 5)))
    everything = formed.copy()
    monkeypatch.undo()
    counts = sorted(rows(basket.co_purchases(items)), key=lambda r: -r[2])
    fifth = counts[4][2]
    assert found == sorted(tuple(r) for r in counts if r[2] >= fifth)
    assert sum(everything) * 20 < sum(r[2] for r in counts)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_frequent_pairs_of_few_or_tied_lines(spark, k):
    draw = random.Random(k)
    lines = sorted({(f"o{draw.randrange(15)}", f"p{draw.randrange(9)}") for _ in range(60)})
    items = spark.createDataFrame(lines, "order_id string, product_id string")
    counts = sorted((r[2], r[0], r[1]) for r in rows(basket.co_purchases(items)))[::-1]
    least = counts[min(k, len(counts)) - 1][0]
    found = sorted((r[2], r[0], r[1]) for r in rows(basket.frequent_pairs(items, k)))[::-1]
    assert found == [c for c in counts if c[0] >= least]
    assert basket.frequent_pairs(items.limit(0), k).count() == 0


def brute_paths(edges, start, hops):
    found, frontier = [], [((start,), (), 0)]
    for _ in range(hops):
        frontier = [
            ((*nodes, b), (*used, e), km + d)
            for nodes, used, km in frontier for e, (a, b, d) in enumerate(edges) if a == nodes[-1] and e not in used
        ]
        found += frontier
    return found


@pytest.mark.parametrize("seed", range(3))
def test_shortest_paths_stop_on_proof(spark, seed, monkeypatch):
    draw = random.Random(seed)
    edges = [(f"l{draw.randrange(7)}", f"l{draw.randrange(7)}", draw.randrange(4)) for _ in range(16)]
    legs = spark.createDataFrame(
        [("c", i, a, b, float(d), 1.0) for i, (a, b, d) in enumerate(edges)],
        "courier_id string, stop_order int, from_location_id string, to_location_id string,"
        " distance_from_previous_km double, estimated_minutes double",
    )
    places = spark.createDataFrame([(f"l{i}", f"L{i}") for i in range(7)], "location_id string, name string")
    hops, step = [], paths._next_hop
    monkeypatch.setattr(paths, "_next_hop", lambda p, e: (hops.append(1), step(p, e))[1])
    found = rows(paths.nearest_destinations(legs, places, "l0", 6, 4))
    want = sorted((km, len(used), nodes[-1]) for nodes, used, km in brute_paths(edges, "l0", 6))[:4]
    assert [(r[2], len(r[1]) - 1, r[0].lower()) for r in found] == want
    assert len(hops) <= max((h for _, h, _ in want), default=0)


def test_a_far_frontier_ends_the_search(spark, monkeypatch):
    legs = spark.createDataFrame(
        [("c", i, "s", f"n{i}", 1.0, 1.0) for i in range(5)] + [("d", i, f"n{i}", f"m{i}", 9.0, 1.0) for i in range(5)],
        "courier_id string, stop_order int, from_location_id string, to_location_id string,"
        " distance_from_previous_km double, estimated_minutes double",
    )
    hops, step = [], paths._next_hop
    monkeypatch.setattr(paths, "_next_hop", lambda p, e: (hops.append(1), step(p, e))[1])
    places = spark.createDataFrame([(f"n{i}", f"N{i}") for i in range(5)] + [("s", "S")], "location_id string, name string")
    assert len(rows(paths.nearest_destinations(legs, places, "s", 8, 5))) == 5
    assert len(hops) == 1


def test_months_of_users_add_up(spark, operational_sample):
    built = star.build_star(operational_sample, resolve=False)
    monthly = materialise(olap.monthly_users(built, sold=("completed", "cancelled")), "monthly")
    rolled = olap.users_rolled_up(monthly, "restaurante", "zona")
    exact = olap.exact_unique_users(built, ("completed", "cancelled"))
    assert sorted(rows(rolled)) == sorted(rows(exact.select(*rolled.columns)))
    # A month alone is the month's own activity.
    months = olap.users_rolled_up(monthly, "restaurante", "zona", "anio", "mes")
    activity = olap.user_activity_by_restaurant(built, ("completed", "cancelled"))
    assert sorted(rows(months.select("restaurante", "anio", "mes", "usuarios_unicos_total", "pedidos_total"))) == sorted(
        rows(activity.select("restaurante", "anio", "mes", "usuarios_unicos", "total_pedidos")))


def test_users_in_many_blocks_and_none(spark, operational_sample):
    built = star.build_star(operational_sample, resolve=False)
    users = built.dim_usuario.select("usuario_id").where("usuario_id is not null").distinct()
    apart = with_ordinal(users, ["usuario_id"]).withColumn("ordinal", F.col("ordinal") * 40_000)
    monthly = olap.monthly_users(built, apart, ("completed",))
    rolled = olap.users_rolled_up(monthly, "restaurante", "zona")
    exact = olap.exact_unique_users(built, ("completed",))
    assert sorted(rows(rolled)) == sorted(rows(exact.select(*rolled.columns)))


def test_users_of_a_restaurant_and_month_are_small_rows(spark, operational_sample):
    """No buffer of thousands of bytes per group, be its users ever so few: sums and words of 64 bits only."""
    built = star.build_star(operational_sample, resolve=False)
    users = built.dim_usuario.select("usuario_id").where("usuario_id is not null").distinct()
    apart = with_ordinal(users, ["usuario_id"]).withColumn("ordinal", F.col("ordinal") * 31 + 63)
    monthly = olap.monthly_users(built, apart, ("completed", "cancelled"))
    rolled = olap.users_rolled_up(monthly, "restaurante", "zona")
    for found in (monthly, rolled):
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
        assert any("bit_or" in line for line in plan)
        assert not any("SortAggregate" in line and ("bit_or" in line or "bitmap" in line) for line in plan)
    exact = olap.exact_unique_users(built, ("completed", "cancelled"))
    assert sorted(rows(rolled)) == sorted(rows(exact.select(*rolled.columns)))
