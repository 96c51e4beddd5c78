"""Dirty input, key collisions, calendar edges, empty tables."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from comanda.functions.calendar import calendar_columns, hour_key
from comanda.functions.geo import great_circle_km
from comanda.functions.keys import one_per_key, surrogate_key
from comanda.functions.numbers import growth_percent
from comanda.operators import graph, olap, paths, quality, routing, sales, star
from comanda.operators.routing import route_edges
from comanda.sources import extracts, normalise, synthetic
from comanda.sources.tables import Tables, jdbc_predicates, load_source, read_documents


def one(spark, sql):
    return spark.sql(sql)


def calendar_of(spark, stamp):
    ts = spark.sql(f"select timestamp '{stamp}' ts")
    return ts.select(*calendar_columns(F.to_date("ts"), F.hour("ts"))).first().asDict()


def test_sunday_is_the_seventh_day(spark):
    day = calendar_of(spark, "2026-05-17 08:00:00")
    assert (day["dia_semana"], day["nombre_dia"], day["es_fin_semana"]) == (7, "Domingo", True)
    monday = calendar_of(spark, "2026-05-18 08:00:00")
    assert (monday["nombre_dia"], monday["es_fin_semana"]) == ("Lunes", False)


def test_new_year_keeps_the_iso_week(spark):
    day = calendar_of(spark, "2027-01-01 00:30:00")
    assert (day["anio"], day["semana"], day["nombre_mes"], day["trimestre"]) == (2027, 53, "Enero", 1)
    assert calendar_of(spark, "2026-12-31 23:59:59")["tiempo_key"] == 2026123123


def test_hour_key_of_a_far_year(spark):
    found = spark.sql("select timestamp '9148-03-04 05:06:07' ts").select(hour_key(F.col("ts")))
    assert found.first()[0] == 9148030405


@pytest.mark.parametrize("strategy", ["crc32", "xxhash64"])
@pytest.mark.parametrize("stored", [False, True])
def test_colliding_keys_change_no_total(spark, strategy, stored):
    """plumless and buckeroo share a CRC-32, as users, restaurants and products."""
    names = ["plumless", "buckeroo", "other"]
    one = spark.createDataFrame([(n,) for n in names], "id string")
    assert one.select(F.crc32("id")).distinct().count() == 2
    source = Tables(
        users=one.selectExpr("id", "id name", "'client' role", "null created_at"),
        restaurants=one.selectExpr("id", "id name", "'Calle' address", "1 capacity"),
        products=one.selectExpr("id", "id name", "'pan' category", "1.0 price", "true available", "'plumless' restaurant_id"),
        orders=one.selectExpr("id", "id user_id", "id restaurant_id", "'confirmed' status", "true pickup", "'2026-01-05 10:00:00' created_at"),
        order_items=one.selectExpr("id || '-1' id", "id order_id", "id product_id", "2 quantity", "5.00 price"),
        reservations=one.selectExpr("id", "id user_id", "id restaurant_id", "'2026-01-05 10:00:00' date", "4 party_size", "'confirmed' status"),
    )
    built = star.build_star(source, resolve=stored, key_strategy=strategy)
    for name in ("usuario", "restaurante", "producto"):
        assert getattr(built, f"dim_{name}").select(f"{name}_key").distinct().count() == 3
    month = (2026, 1, "Enero")
    ten, all_of = Decimal("10.00"), Decimal("30.00")
    assert rows(olap.total_revenue(built)) == [(all_of, 3)]
    assert rows(olap.revenue_by_month_category(built)) == [(*month, "pan", 3, 6, all_of, 10.0)]
    assert sorted(rows(olap.user_activity_by_restaurant(built))) == [
        (n, "Calle", *month, 1, 1, ten) for n in sorted(names)
    ]
    assert sorted(r[4:] for r in rows(olap.consumption_ranking(built))) == [
        (n, 2, ten, 1) for n in sorted(names)
    ]
    assert sorted(r[0] for r in rows(olap.best_sellers(built))) == sorted(names)
    assert sorted(rows(olap.activity_per_user(built))) == [(n, n, 1, ten) for n in sorted(names)]
    assert sorted(rows(olap.revenue_per_restaurant(built))) == [(n, ten) for n in sorted(names)]
    assert sorted(rows(olap.reservations_by_restaurant(built))) == [(n, "Calle", 1, 4) for n in sorted(names)]
    assert sorted(rows(olap.exact_unique_users(built))) == [(n, "Calle", 1, 1, ten) for n in sorted(names)]
    with pytest.raises(ValueError):
        surrogate_key(F.lit("x"), "sum")


def test_an_empty_zone_is_none(spark):
    orders = spark.createDataFrame(
        [("o1", "", 1.0), ("o2", None, 1.0), ("o3", "Norte", 1.0)], "order_id string, zone string, v double"
    ).selectExpr("order_id", "'u' user_id", "timestamp '2026-01-01 00:00:00' created_at", "'pending' status",
                 "zone", "v delivery_latitude", "v delivery_longitude")
    found = {r["order_id"]: r["zone"] for r in routing.routable_orders(orders).collect()}
    assert found == {"o1": "Sin zona", "o2": "Sin zona", "o3": "Norte"}


def test_the_fleet_grows_with_the_orders(spark):
    orders = spark.range(100).selectExpr(
        "cast(id as string) order_id", "'u' user_id", "timestamp_seconds(id) created_at", "'pending' status",
        "'z' zone", "double(9.9) + id / 1000 delivery_latitude", "double(-84) delivery_longitude")
    routes = routing.route_assignments(orders)
    sizes = [r[1] for r in rows(routes.groupBy("courier_id").count())]
    assert sorted(sizes) == [33, 33, 34]


def test_a_negative_leg_raises(spark):
    edges = spark.createDataFrame(
        [("c", 1, "loc-central", "a", -1.0, 1.0)],
        "courier_id string, stop_order int, from_location_id string, to_location_id string, "
        "distance_from_previous_km double, estimated_minutes double",
    )
    places = spark.createDataFrame([("a", "A"), ("loc-central", "C")], "location_id string, name string")
    with pytest.raises(Exception, match="negative"):
        rows(paths.nearest_destinations(edges, places))


def test_newest_row_of_a_key_is_kept(spark):
    df = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 2), ("b", None, None), ("a", "older", 0)],
        "id string, name string, at int",
    ).repartition(3)
    assert sorted(rows(one_per_key(df, "id", ["at"]))) == [("a", "new", 2), ("b", None, None)]


def test_unparsable_and_missing_values(spark):
    orders = spark.createDataFrame(
        [("1", "not a time", "9.x"), ("2", "2026-01-01 10:00:00", "9.5"), (None, None, None)],
        "_id string, created_at string, latitude string",
    )
    found = sorted(rows(normalise.normalise_orders(orders)))
    moment = dt.datetime(2026, 1, 1, 10)
    assert found == [
        ("1", None, None, None, "unknown", None, None, "Sin zona"),
        ("2", None, None, moment, "unknown", 9.5, None, "Sin zona"),
    ]
    products = spark.createDataFrame([("7", "dear")], "id string, price string")
    assert rows(normalise.normalise_products(products)) == [
        ("7", None, "sin_categoria", Decimal("0.00"))
    ]
    items = spark.createDataFrame([("o", "p", None), (None, "p", "2")], "order_id string, id string, quantity string")
    assert rows(normalise.normalise_order_items(items)) == [("o", "p", 1, Decimal("0.00"))]
    booked = spark.createDataFrame(
        [("r", "2026-02-03 04:05:06", "2026-01-01 00:00:00")], "id string, date string, created_at string"
    )
    assert normalise.normalise_reservations(booked).first()["reservation_time"] == dt.datetime(2026, 2, 3, 4, 5, 6)
    users = spark.createDataFrame([("u", "Heredia")], "_id string, city string")
    assert normalise.normalise_users(users).first()["zone"] == "Heredia"


@pytest.fixture(scope="module")
def dirty(spark):
    """Unknown members, no timestamp, large money, an item without an order."""
    return Tables(
        users=spark.createDataFrame([("u1", "Ana")], "id string, name string").selectExpr(
            "*", "'client' role", "null created_at"),
        restaurants=spark.createDataFrame([("r1", "Casa", "Calle", "x")], "id string, name string, address string, capacity string"),
        products=spark.createDataFrame([("p1", "Pan", "pan", "3.5", "true", "r1")], "id string, name string, category string, price string, available string, restaurant_id string"),
        orders=spark.createDataFrame(
            [("o1", "u1", "r1", "confirmed", "true", "2026-01-05 10:00:00"),
             ("o2", "u9", None, "confirmed", "no", "2026-03-05 10:00:00"),
             ("o3", "u1", "r1", "confirmed", None, None),
             ("o4", "u1", "r1", "confirmed", None, "2026-04-05 10:00:00")],
            "id string, user_id string, restaurant_id string, status string, pickup string, created_at string"),
        order_items=spark.createDataFrame(
            [("i1", "o1", "p1", "2", "900000000.25"), ("i2", "o2", "p9", "1", "0"),
             ("i3", "o3", "p1", "1", "5"), ("i4", "gone", "p1", "1", "5"), ("i5", "o4", "p1", "1", "7")],
            "id string, order_id string, product_id string, quantity string, price string"),
        reservations=spark.createDataFrame(
            [("v1", "u1", "r9", None, "4", "confirmed")],
            "id string, user_id string, restaurant_id string, date string, party_size string, status string"),
    )


def test_unknown_members_have_no_key(dirty):
    built = star.build_star(dirty)
    found = {(t, k): n for t, k, n in rows(quality.dangling_keys(built))}
    assert found == {
        ("fact_items_pedido", "tiempo_key"): 1, ("fact_items_pedido", "usuario_key"): 1,
        ("fact_items_pedido", "restaurante_key"): 1, ("fact_items_pedido", "producto_key"): 1,
        ("fact_reservaciones", "tiempo_key"): 1, ("fact_reservaciones", "usuario_key"): 0,
        ("fact_reservaciones", "restaurante_key"): 1,
    }
    fact = {r["item_id"]: r for r in built.fact_items_pedido.collect()}
    assert set(fact) == {"i1", "i2", "i3", "i5"}
    assert fact["i1"]["monto_total"] == Decimal("1800000000.50")
    assert built.dim_restaurante.first()["capacidad"] is None


@pytest.mark.parametrize("resolve", [True, False])
def test_views_drop_unknown_members(dirty, resolve):
    built = star.build_star(dirty, resolve=resolve)
    found = rows(olap.revenue_by_month_category(built).select("mes", "ingresos_totales"))
    assert sorted(found) == [(1, Decimal("1800000000.50")), (4, Decimal("7.00"))]
    users = rows(olap.user_activity_by_restaurant(built).select("mes", "usuarios_unicos"))
    assert sorted(users) == [(1, 1), (4, 1)]


def test_growth_skips_gaps_and_zero_months(dirty):
    built = star.build_star(dirty, resolve=False)
    found = rows(olap.monthly_growth(built).select("mes", "ingresos_mes", "ingresos_mes_anterior", "crecimiento_pct"))
    assert found == [
        (1, Decimal("1800000000.50"), None, None),
        (3, Decimal("0.00"), Decimal("1800000000.50"), -100.0),
        (4, Decimal("7.00"), Decimal("0.00"), None),
    ]


def test_growth_rounds_half_up(spark):
    df = spark.sql("select 2000.01BD now, 1600.00BD before").select(
        growth_percent(F.col("now").cast("decimal(28,2)"), F.col("before").cast("decimal(28,2)"))
    )
    assert df.first()[0] == 25.0


def test_empty_tables(spark, dirty, operational_sample):
    empty = Tables(**{name: df.limit(0) for name, df in operational_sample.items()})
    built = star.build_star(empty)
    assert olap.revenue_by_month_category(built).count() == 0
    assert olap.monthly_growth(built).count() == 0
    data = normalise.normalise(empty)
    assert sales.consumption_trends(data).count() == 0
    assert graph.bought_together(data).count() == 0
    routes = routing.route_assignments(data.orders, stops_per_courier=5)
    assert routes.count() == 0 and route_edges(routes).count() == 0
    with pytest.raises(quality.SourceNotReady):
        quality.require_rows({"orders": empty.orders})


def test_self_referral_is_an_edge(spark):
    users = spark.createDataFrame([("u", "Ana", "u"), ("v", "Eva", "gone")], "user_id string, name string, referred_by string")
    assert rows(graph.recommends(Tables(users=users))) == [("u", "u")]


def test_equal_places_keep_their_order(spark):
    orders = spark.range(9).selectExpr(
        "timestamp '2026-01-01' created_at", "concat('o', id) order_id", "'u' user_id",
        "string(null) zone", "'pending' status", "10.0D delivery_latitude", "-84.0D delivery_longitude",
    )
    found = sorted(rows(routing.route_assignments(orders, 1).select("stop_order", "order_id", "zone")))
    assert found == [(i + 1, f"o{i}", "Sin zona") for i in range(9)]


def test_distance(spark):
    km = spark.range(1).select(great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert km.first()[0] == pytest.approx(6371 * 3.141592653589793 / 2)


def test_same_product_twice_is_one_edge(spark):
    data = Tables(
        orders=spark.createDataFrame([("o",)], "order_id string"),
        products=spark.createDataFrame([("p",)], "product_id string"),
        order_items=spark.createDataFrame(
            [("o", "p", 1, 2.0), ("o", "p", 3, 2.0), ("o", "x", 1, 1.0), ("y", "p", 1, 1.0)],
            "order_id string, product_id string, quantity int, unit_price double",
        ).withColumn("unit_price", F.col("unit_price").cast("decimal(18,2)")),
    )
    assert rows(graph.contains(data)) == [("o", "p", 4, Decimal("2.00"), Decimal("8.00"))]


def test_catalogue_changes_and_fingerprint(spark):
    schema = "id string, name string, category string, price int, available boolean"
    old = spark.createDataFrame([("1", "a", None, 1, True), ("2", None, "b", 1, True), ("3", "c", "c", 1, None)], schema)
    new = spark.createDataFrame([("1", "a", None, 1, True), ("2", "b", None, 1, True), ("4", "d", "d", 1, None)], schema)
    found = {r["id"]: r["change"] for r in quality.catalogue_changes(old, new).collect()}
    assert found == {"2": "changed", "3": "removed", "4": "added"}
    prints = [quality.fingerprint(df).first() for df in (old, old.repartition(7), new)]
    assert prints[0] == prints[1] != prints[2]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = graph.upsert(old, new, "k")
    assert sorted(rows(once)) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(rows(graph.upsert(once, new, "k"))) == sorted(rows(once))


def test_jdbc_predicates_split_every_row_once(spark):
    df = spark.range(1000).selectExpr("if(id % 9 = 0, null, concat('k', id)) id")
    parts = [df.where(p).count() for p in jdbc_predicates("id", 7, "hash({column})")]
    assert sum(parts) == 1000 and min(parts) > 50


def test_source_dispatch(spark, raw_sample):
    def broken(_):
        raise RuntimeError("down")

    loaders = {"broken": broken, "sample": lambda _: raw_sample}
    with pytest.raises(RuntimeError):
        load_source(spark, "broken", loaders)
    assert load_source(spark, "broken", loaders, fallback="sample") is raw_sample
    with pytest.raises(ValueError):
        load_source(spark, "other", loaders)


def test_documents(spark, tmp_path):
    path = tmp_path / "users.json"
    path.write_text('{"_id": "a", "name": "Ana", "city": "Cartago"}\n{"_id": "b"}\n')
    found = sorted(rows(normalise.normalise_users(read_documents(spark, str(path)))))
    assert found[0][:3] == ("a", "Ana", "Cartago") and found[1][:3] == ("b", None, "Sin zona")


def test_extract_by_sql(spark, operational_sample):
    found = extracts.run_sql(
        spark, operational_sample, "select count(*) n from {orders} where status = 'completed'"
    )
    assert found.first()["n"] == 7


def test_generated_transactions(spark, operational_sample):
    def make(parts):
        tables = {n: df.repartition(parts) for n, df in operational_sample.items()}
        return synthetic.generate(
            spark, tables["users"], tables["restaurants"], tables["products"], 2000, 500, seed=1
        )

    made, again = make(1), make(6)
    for name in ("orders", "order_items", "reservations", "users"):
        assert sorted(rows(getattr(made, name)), key=repr) == sorted(rows(getattr(again, name)), key=repr)
    # Only r1 has a menu: orders of the other two restaurants are left out.
    orders = made.orders.collect()
    assert {o["restaurant_id"] for o in orders} == {"r1"} and 500 < len(orders) < 850
    share = sum(o["status"] == "confirmed" for o in orders) / len(orders)
    assert 0.68 < share < 0.82
    per_order = made.order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("d")
    )
    assert {(r["n"] == r["d"], 1 <= r["n"] <= 4) for r in per_order.collect()} == {(True, True)}
    assert {r["quantity"] for r in made.order_items.collect()} == {1, 2, 3}
    assert {r["party_size"] for r in made.reservations.collect()} == set(range(1, 9))
    booked = made.reservations.select((F.unix_timestamp("date") - F.unix_timestamp("created_at")) / 3600)
    assert {1 <= r[0] <= 48 for r in booked.collect()} == {True}
    referred = [r for r in made.users.collect() if r["referred_by"]]
    assert len({r["referred_by"] for r in referred}) <= 1
