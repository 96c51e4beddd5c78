"""Results on the sample, worked out by hand. Sold means completed."""

from decimal import Decimal

import pytest
from conftest import rows

from comanda.constants import SMALL_FLEET
from comanda.operators import basket, graph, olap, paths, routing, sales, star
from comanda.session import materialise

SOLD = ("completed",)


@pytest.fixture(scope="module")
def built(operational_sample):
    return star.build_star(operational_sample)


def test_hours(built):
    assert built.dim_tiempo.count() == 12


def test_private_columns_stay_out(built):
    assert built.dim_usuario.columns == [
        "usuario_key", "usuario_id", "nombre", "rol", "fecha_registro"
    ]


def test_revenue_by_month_category(built):
    found = olap.revenue_by_month_category(built, SOLD).drop("anio", "nombre_mes")
    assert sorted((r[0], r[1], r[2], r[3], int(r[4]), r[5]) for r in rows(found)) == [
        (4, "acompanamientos", 2, 3, 4500, 2250.0),
        (4, "bebidas", 2, 3, 5400, 2700.0),
        (4, "hamburguesas", 1, 2, 7800, 7800.0),
        (4, "pizzas", 2, 2, 9700, 4850.0),
        (5, "bebidas", 1, 1, 1800, 1800.0),
        (5, "hamburguesas", 1, 1, 3900, 3900.0),
        (5, "pizzas", 1, 2, 9000, 9000.0),
        (5, "postres", 1, 2, 3200, 3200.0),
        (6, "acompanamientos", 1, 1, 1500, 1500.0),
        (6, "bebidas", 1, 2, 3600, 3600.0),
        (6, "hamburguesas", 1, 1, 3900, 3900.0),
        (6, "pizzas", 1, 1, 5200, 5200.0),
        (6, "postres", 1, 1, 1600, 1600.0),
    ]


def test_user_activity(built):
    found = olap.user_activity_by_restaurant(built, SOLD)
    picked = found.select("restaurante", "mes", "usuarios_unicos", "total_pedidos", "ingresos")
    assert sorted(rows(picked.selectExpr("*", "1").drop("1"))) == [
        ("Casa 1", 4, 2, 2, Decimal("16600.00")),
        ("Casa 1", 5, 1, 1, Decimal("12200.00")),
        ("Casa 1", 6, 1, 1, Decimal("8800.00")),
        ("Casa 2", 4, 1, 1, Decimal("10800.00")),
        ("Casa 2", 6, 1, 1, Decimal("7000.00")),
        ("Casa 3", 5, 1, 1, Decimal("5700.00")),
    ]


def test_status_mix(built):
    found = olap.order_status_mix(built).drop("anio", "nombre_mes")
    assert sorted((r[0], r[1], r[2], int(r[3]), r[4]) for r in rows(found)) == [
        (4, "completed", 3, 27400, 100.0),
        (5, "cancelled", 1, 6100, 33.33),
        (5, "completed", 2, 17900, 66.67),
        (6, "completed", 2, 15800, 100.0),
    ]


def test_ranking_ties(built):
    found = rows(olap.consumption_ranking(built, SOLD).select("mes", "producto", "ranking_en_categoria"))
    assert {rank for _, _, rank in found} == {1}
    assert {(4, "Pizza margarita", 1), (4, "Pizza pepperoni", 1)} <= set(found)


def test_peak_hours_weekday(built):
    found = olap.peak_hours_weekday(built, SOLD)
    shaped = [(r[0], r[1], r[3], r[4], int(r[5]), r[6]) for r in rows(found)]
    assert sorted(shaped) == [
        (12, "Martes", 1, 3, 8800, 4400.0),
        (12, "Miércoles", 2, 6, 16600, 3320.0),
        (13, "Martes", 1, 2, 5700, 2850.0),
        (19, "Miércoles", 1, 4, 12200, 6100.0),
        (19, "Viernes", 1, 4, 10800, 5400.0),
        (21, "Miércoles", 1, 3, 7000, 2333.33),
    ]


GROWTH = [(27400, 3, None, None), (17900, 2, 27400, -34.67), (15800, 2, 17900, -11.73)]


def test_monthly_growth(built, sample_data):
    star_rows = olap.monthly_growth(built, SOLD).select(
        "ingresos_mes", "total_pedidos", "ingresos_mes_anterior", "crecimiento_pct"
    )
    flat_rows = sales.monthly_growth(sample_data).select(
        "revenue", "orders_count", "previous_month_revenue", "growth_pct"
    )
    assert rows(star_rows) == rows(flat_rows) == GROWTH


def test_peak_hours_flat(sample_data):
    assert rows(sales.peak_hours(sample_data)) == [
        (12, 3, 25400, 9), (19, 2, 23000, 8), (21, 1, 7000, 3), (13, 1, 5700, 2)
    ]


def test_reservations(sample_data):
    assert rows(sales.reservations_summary(sample_data.reservations)) == [
        ("2026-04", "cancelled", 1, 4),
        ("2026-04", "confirmed", 1, 2),
        ("2026-05", "confirmed", 2, 8),
        ("2026-06", "completed", 1, 2),
    ]


CO_PURCHASES = [
    ("p1", "p6", 2), ("p2", "p5", 2), ("p3", "p4", 2), ("p1", "p5", 1), ("p2", "p4", 1),
    ("p3", "p5", 1), ("p3", "p6", 1), ("p4", "p5", 1), ("p4", "p6", 1),
]


def test_co_purchases(sample_data):
    pairs = basket.co_purchases(sample_data.order_items)
    assert rows(basket.most_frequent_first(pairs)) == CO_PURCHASES


def test_influence_and_activity(sample_data):
    assert rows(graph.influential_users(sample_data)) == [
        ("u1", "Ana", 2, "u2", "Luis"), ("u1", "Ana", 2, "u3", "Sofía"),
        ("u2", "Luis", 1, "u4", "Marco"),
    ]
    assert [r[1:] for r in rows(graph.active_users(sample_data))] == [
        ("Ana", 2), ("Luis", 2), ("Sofía", 2), ("Marco", 1), ("Valeria", 1)
    ]


def test_category_units(sample_data):
    assert rows(graph.category_units(sample_data)) == [
        ("pizzas", 6, 28400), ("hamburguesas", 4, 15600), ("bebidas", 6, 10800),
        ("postres", 4, 6400), ("acompanamientos", 4, 6000),
    ]


ROUTES = [
    ("courier-1", 1, "o1", 3.221, 7.73, 3.221),
    ("courier-1", 2, "o6", 0.0, 0.0, 3.221),
    ("courier-1", 3, "o3", 9.964, 23.91, 13.184),
    ("courier-1", 4, "o8", 0.0, 0.0, 13.184),
    ("courier-2", 1, "o2", 5.287, 12.69, 5.287),
    ("courier-2", 2, "o7", 0.0, 0.0, 5.287),
    ("courier-2", 3, "o5", 13.832, 33.2, 19.119),
]


@pytest.fixture(scope="module")
def routes(sample_data):
    return materialise(routing.route_assignments(sample_data.orders, SMALL_FLEET), "routes")


def test_routes(routes):
    found = routes.select(
        "courier_id", "stop_order", "order_id", "distance_from_previous_km",
        "estimated_minutes", "accumulated_km",
    )
    assert sorted(rows(found)) == ROUTES


def test_route_edges(routes):
    found = routing.route_edges(routes).select("from_location_id", "to_location_id")
    assert set(rows(found)) == {
        ("loc-central", "loc-o1"), ("loc-o1", "loc-o6"), ("loc-o6", "loc-o3"),
        ("loc-o3", "loc-o8"), ("loc-central", "loc-o2"), ("loc-o2", "loc-o7"),
        ("loc-o7", "loc-o5"),
    }


def test_nearest(routes):
    edges = routing.route_edges(routes)
    found = rows(paths.nearest_destinations(edges, graph.delivery_locations(routes)))
    assert [(r[0], r[2]) for r in found] == [
        ("Entrega o1", 3.221), ("Entrega o6", 3.221), ("Entrega o2", 5.287),
        ("Entrega o7", 5.287), ("Entrega o3", 13.185),
    ]
    assert found[4][1] == ["Centro de distribución", "Entrega o1", "Entrega o6", "Entrega o3"]
