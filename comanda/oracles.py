"""The registered queries as plain SQL over the wholesale tables, for DuckDB.

Averages and percentages are worked out on integer cents, so that they round
as exact decimals do.
"""

from __future__ import annotations

from comanda.constants import (
    COURIER_KMH,
    COURIER_PREFIX,
    DEFAULT_ZONE,
    DELIVERY_NAME_PREFIX,
    DEPOT_ID,
    DEPOT_LATITUDE,
    DEPOT_LONGITUDE,
    DEPOT_NAME,
    EARTH_RADIUS_KM,
    LOCATION_PREFIX,
    MONTH_NAMES,
    ROUTABLE_STATUSES,
    SHIFT_GAP,
    STOPS_PER_COURIER,
    WEEKDAY_NAMES,
)

MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"
WEEKDAYS_SQL = "[" + ", ".join(f"'{d}'" for d in WEEKDAY_NAMES) + "]"

SOURCES = """
src_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS role, n_name AS zone,
         CAST(DATE '1992-01-01' + CAST(c_custkey %% 2000 AS INTEGER) AS TIMESTAMP) AS created_at,
         CASE WHEN c_custkey % 2 = 1 THEN CAST(c_custkey // 3 AS VARCHAR) END AS referred_by
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
src_restaurants AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, n_name AS address,
         CAST(s_suppkey %% 40 + 10 AS INTEGER) AS capacity
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
src_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_size > 5 AS available,
         CAST(p_partkey %% (SELECT COUNT(*) FROM supplier) AS VARCHAR) AS restaurant_id
  FROM part),
src_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST((o_orderkey * 7 + o_custkey) %% (SELECT COUNT(*) FROM supplier) AS VARCHAR) AS restaurant_id,
         CASE WHEN o_orderkey %% 10 = 0 THEN o_orderkey END AS reservation_id,
         CASE WHEN o_orderstatus = 'F' THEN 'confirmed' WHEN o_orderstatus = 'P' THEN 'cancelled'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'in_progress'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'completed'
              WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'unknown' END AS status,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS pickup,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created_at,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total,
         CAST(%(lat)s AS DOUBLE) + CAST((o_custkey * 37) %% 1000 - 500 AS DOUBLE) / 5000.0::DOUBLE AS latitude,
         CAST(%(lon)s AS DOUBLE) + CAST((o_custkey * 91) %% 1000 - 500 AS DOUBLE) / 5000.0::DOUBLE AS longitude
  FROM orders),
src_items AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem),
src_reservations AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id %% (SELECT COUNT(*) FROM supplier) AS VARCHAR) AS restaurant_id, ts AS date,
         CAST(1 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 AS INTEGER) AS party_size,
         event_type AS status
  FROM events)
""".replace("%(lat)s", str(DEPOT_LATITUDE)).replace("%(lon)s", str(DEPOT_LONGITUDE)).replace(
    "%%", "%"
)

LINES = """
lines AS (
  SELECT o.id AS pedido_id, o.user_id, o.restaurant_id, i.product_id, i.id AS item_id,
         i.quantity AS cantidad, i.price AS precio,
         CAST(i.quantity * i.price AS DECIMAL(18,2)) AS monto,
         o.status AS estado, o.pickup, o.created_at AS ts
  FROM src_items i JOIN src_orders o ON i.order_id = o.id)
"""


def with_sources(body: str, *ctes: str, recursive: bool = False) -> str:
    keyword = "WITH RECURSIVE" if recursive else "WITH"
    return f"{keyword} {', '.join([SOURCES, *ctes])} {body}"


def on_lines(body: str, *ctes: str) -> str:
    return with_sources(body, LINES, *ctes)


def money(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DECIMAL(28,2))"


def _cents(expr: str) -> str:
    return f"CAST({expr} * 100 AS HUGEINT)"


def average(expr: str) -> str:
    """Decimal average with six places, half up, then rounded to two."""
    total, n = f"SUM({_cents(expr)})", f"COUNT({expr})"
    six = f"((2 * {total} * 10000 + {n}) // (2 * {n}))"
    return f"CAST(({six} + 5000) // 10000 AS DOUBLE) / 100"


def percent(part: str, whole: str) -> str:
    part, whole = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CAST((2 * {part} * 10000 + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


def growth(now: str, before: str) -> str:
    change = f"({_cents(now)} - {_cents(before)})"
    base = _cents(before)
    size = f"CAST((2 * abs({change}) * 10000 + {base}) // (2 * {base}) AS DOUBLE) / 100"
    return f"CASE WHEN {before} <> 0 THEN sign({change}) * {size} END"


def units(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


def count_of(name: str) -> str:
    return f"CAST(COUNT(DISTINCT {name}) AS BIGINT)"


MONTH_PARTS = (
    "CAST(year(ts) AS INTEGER) AS anio, CAST(month(ts) AS INTEGER) AS mes, "
    f"{MONTHS_SQL}[month(ts)] AS nombre_mes"
)

REVENUE = f"""
revenue AS (
  SELECT {MONTH_PARTS}, p.category AS categoria, {count_of("pedido_id")} AS total_pedidos,
         {units("cantidad")} AS unidades_vendidas, {money("monto")} AS ingresos_totales,
         {average("monto")} AS ticket_promedio
  FROM lines JOIN src_products p ON p.id = product_id
  WHERE estado = 'confirmed' GROUP BY 1, 2, 3, 4)
"""

ACTIVITY = f"""
activity AS (
  SELECT r.name AS restaurante, r.address AS zona, {MONTH_PARTS},
         {count_of("user_id")} AS usuarios_unicos, {count_of("pedido_id")} AS total_pedidos,
         {money("monto")} AS ingresos
  FROM lines JOIN src_restaurants r ON r.id = restaurant_id
  WHERE estado = 'confirmed' GROUP BY 1, 2, 3, 4, 5)
"""

STATUS = f"""
by_status AS (
  SELECT {MONTH_PARTS}, estado AS estado_pedido, {count_of("pedido_id")} AS total_pedidos,
         {money("monto")} AS monto_total
  FROM lines GROUP BY 1, 2, 3, 4),
mix AS (
  SELECT *, {percent("total_pedidos", "SUM(total_pedidos) OVER (PARTITION BY anio, mes)")}
            AS porcentaje
  FROM by_status)
"""

RANKING = f"""
products_sold AS (
  SELECT {MONTH_PARTS}, p.category AS categoria, p.name AS producto,
         {units("cantidad")} AS unidades_vendidas, {money("monto")} AS ingresos
  FROM lines JOIN src_products p ON p.id = product_id
  WHERE estado = 'confirmed' GROUP BY 1, 2, 3, 4, 5),
ranking AS (
  SELECT *, RANK() OVER (PARTITION BY anio, mes, categoria ORDER BY unidades_vendidas DESC)
            AS ranking_en_categoria
  FROM products_sold)
"""

PEAKS = f"""
peaks AS (
  SELECT CAST(hour(ts) AS INTEGER) AS hora, {WEEKDAYS_SQL}[isodow(ts)] AS nombre_dia,
         isodow(ts) IN (6, 7) AS es_fin_semana, {count_of("pedido_id")} AS total_pedidos,
         {units("cantidad")} AS unidades_vendidas, {money("monto")} AS ingresos,
         {average("monto")} AS ticket_promedio
  FROM lines WHERE estado = 'confirmed' GROUP BY 1, 2, 3)
"""

HOUR_KEY = "year({0}) * 1000000 + month({0}) * 10000 + day({0}) * 100 + hour({0})"

CO_PURCHASES = """
baskets AS (SELECT DISTINCT order_id, product_id FROM src_items),
pairs AS (
  SELECT a.product_id AS product_a_id, b.product_id AS product_b_id, COUNT(*) AS times
  FROM baskets a JOIN baskets b ON a.order_id = b.order_id AND a.product_id < b.product_id
  GROUP BY 1, 2)
"""

RECOMMENDS = """
recommends AS (
  SELECT DISTINCT u.referred_by AS from_user_id, u.id AS to_user_id
  FROM src_users u JOIN src_users f ON f.id = u.referred_by)
"""

CONTAINS = f"""
contains AS (
  SELECT i.order_id, i.product_id, {units("i.quantity")} AS quantity,
         MAX(i.price) AS unit_price, {money("CAST(i.quantity * i.price AS DECIMAL(18,2))")} AS line_total
  FROM src_items i JOIN src_orders o ON o.id = i.order_id
  JOIN src_products p ON p.id = i.product_id GROUP BY 1, 2)
"""

PERTURBED = """
later AS (
  SELECT CASE WHEN CAST(id AS BIGINT) % 17 = 2 THEN name || ' nuevo' ELSE name END AS name,
         CAST(CASE WHEN CAST(id AS BIGINT) % 17 = 1 THEN price + 1 ELSE price END
              AS DECIMAL(18,2)) AS price,
         CASE WHEN CAST(id AS BIGINT) % 17 = 3 THEN NULL ELSE available END AS available,
         id, category
  FROM src_products WHERE CAST(id AS BIGINT) % 17 <> 0
  UNION ALL
  SELECT name, price, available, 'n' || id, category
  FROM src_products WHERE CAST(id AS BIGINT) % 17 = 4)
"""

QUEUE = f"""
routable AS (
  SELECT id AS order_id, user_id, latitude, longitude,
         row_number() OVER (ORDER BY created_at, id) - 1 AS ordinal
  FROM src_orders WHERE status IN {ROUTABLE_STATUSES}),
stops AS (
  SELECT *, ordinal % (SELECT CAST(ceil(COUNT(*) / {STOPS_PER_COURIER}.0) AS BIGINT) FROM routable)
            AS courier
  FROM routable)
"""


# Shifts: orders of which each follows within the gap; the fleet follows from the shift.
SHIFT_QUEUE = f"""
routable AS (
  SELECT id AS order_id, user_id, latitude, longitude, created_at
  FROM src_orders WHERE status IN {ROUTABLE_STATUSES}),
begun AS (
  SELECT *, coalesce(created_at - lag(created_at) OVER (ORDER BY created_at) > INTERVAL '{SHIFT_GAP}', true) AS first
  FROM routable),
numbered AS (
  SELECT *, SUM(first::BIGINT) OVER (ORDER BY created_at ROWS UNBOUNDED PRECEDING) AS nth FROM begun),
dealt AS (
  SELECT *, '{DEFAULT_ZONE} ' || strftime(MIN(created_at) OVER (PARTITION BY nth), '%Y-%m-%d %H:%M:%S') AS shift,
         row_number() OVER (PARTITION BY nth ORDER BY created_at, order_id) - 1 AS place,
         CAST(ceil(COUNT(*) OVER (PARTITION BY nth) / {STOPS_PER_COURIER}.0) AS BIGINT) AS fleet
  FROM numbered),
shift_stops AS (SELECT *, place % fleet AS own FROM dealt),
stops AS (
  SELECT order_id, user_id, latitude, longitude, shift, own,
         row_number() OVER (ORDER BY shift, place) - 1 AS ordinal,
         dense_rank() OVER (ORDER BY shift, own) - 1 AS courier
  FROM shift_stops)
"""


def _great_circle(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half_lat = f"sin(radians({lat2} - {lat1}) / 2)"
    half_lon = f"sin(radians({lon2} - {lon1}) / 2)"
    chord = (
        f"({half_lat} * {half_lat} + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * ({half_lon} * {half_lon}))"
    )
    return f"{2 * EARTH_RADIUS_KM}::DOUBLE * atan2(sqrt({chord}), sqrt(1 - {chord}))"


# Greedy tours: each step keeps, per courier, the open stop nearest to the last.
TOUR = f"""
tour AS (
  SELECT courier, 0 AS stop_order, CAST(-1 AS BIGINT) AS ordinal,
         {DEPOT_LATITUDE}::DOUBLE AS latitude, {DEPOT_LONGITUDE}::DOUBLE AS longitude,
         0.0::DOUBLE AS leg, 0.0::DOUBLE AS driven, CAST([] AS BIGINT[]) AS seen
  FROM (SELECT DISTINCT courier FROM stops) depots
  UNION ALL
  SELECT courier, stop_order, ordinal, latitude, longitude, next_leg, driven + next_leg,
         list_append(seen, ordinal)
  FROM (
    SELECT t.courier, t.stop_order + 1 AS stop_order, s.ordinal, s.latitude, s.longitude,
           {_great_circle("t.latitude", "t.longitude", "s.latitude", "s.longitude")} AS next_leg,
           t.driven, t.seen
    FROM tour t JOIN stops s ON s.courier = t.courier AND NOT list_contains(t.seen, s.ordinal)
    QUALIFY row_number() OVER (PARTITION BY t.courier ORDER BY next_leg, s.ordinal) = 1) nearest),
routes AS (
  SELECT '{COURIER_PREFIX}' || (t.courier + 1) AS courier_id, t.stop_order, s.order_id, s.user_id,
         '{LOCATION_PREFIX}' || s.order_id AS location_id, 'Sin zona' AS zone,
         s.latitude, s.longitude, round(leg, 3) AS distance_from_previous_km,
         round(leg / {COURIER_KMH}::DOUBLE * 60.0::DOUBLE, 2) AS estimated_minutes,
         round(driven, 3) AS accumulated_km
  FROM tour t JOIN stops s USING (ordinal)),
edges AS (
  SELECT courier_id, stop_order,
         coalesce(lag(location_id) OVER (PARTITION BY courier_id ORDER BY stop_order),
                  '{DEPOT_ID}') AS from_location_id,
         location_id AS to_location_id, distance_from_previous_km, estimated_minutes
  FROM routes),
places AS (
  SELECT '{DEPOT_ID}' AS location_id, '{DEPOT_NAME}' AS name,
         {DEPOT_LATITUDE}::DOUBLE AS latitude, {DEPOT_LONGITUDE}::DOUBLE AS longitude
  UNION ALL
  SELECT DISTINCT location_id, '{DELIVERY_NAME_PREFIX}' || order_id, latitude, longitude
  FROM routes),
legs AS (
  SELECT e.courier_id AS repartidor, e.stop_order AS parada, f.name AS desde, t.name AS hacia,
         e.distance_from_previous_km AS distancia_km, e.estimated_minutes AS tiempo_min
  FROM edges e JOIN places f ON f.location_id = e.from_location_id
  JOIN places t ON t.location_id = e.to_location_id)
"""


def on_routes(body: str, *ctes: str) -> str:
    return with_sources(body, QUEUE, TOUR, *ctes, recursive=True)


def _paths(max_hops: int) -> str:
    return f"""
    walk AS (
      SELECT to_location_id AS here, [from_location_id, to_location_id] AS nodes,
             [(courier_id, stop_order)] AS used, 1 AS hops,
             CAST(distance_from_previous_km AS DECIMAL(18,3)) AS km,
             CAST(estimated_minutes AS DECIMAL(18,2)) AS minutes
      FROM edges WHERE from_location_id = '{DEPOT_ID}'
      UNION ALL
      SELECT e.to_location_id, list_append(w.nodes, e.to_location_id),
             list_append(w.used, (e.courier_id, e.stop_order)), w.hops + 1,
             CAST(w.km + CAST(e.distance_from_previous_km AS DECIMAL(18,3)) AS DECIMAL(18,3)),
             CAST(w.minutes + CAST(e.estimated_minutes AS DECIMAL(18,2)) AS DECIMAL(18,2))
      FROM walk w JOIN edges e ON e.from_location_id = w.here
      WHERE w.hops < {max_hops} AND NOT list_contains(w.used, (e.courier_id, e.stop_order)))
    """


ROUTE_COLUMNS = (
    "courier_id, stop_order, order_id, user_id, location_id, zone, latitude, longitude, "
    "distance_from_previous_km, estimated_minutes, accumulated_km"
)

STOP_ROWS = f"""
stop_rows AS (
  SELECT courier_id AS repartidor, stop_order AS parada, order_id AS pedido,
         '{DELIVERY_NAME_PREFIX}' || order_id AS ubicacion, zone AS zona,
         distance_from_previous_km AS distancia_desde_anterior_km,
         estimated_minutes AS tiempo_estimado_min, accumulated_km AS distancia_acumulada_km
  FROM routes)
"""

ORACLES: dict[str, str] = {
    "dim_tiempo": with_sources(
        f"""
        SELECT DISTINCT {HOUR_KEY.format("h")} AS tiempo_key, CAST(h AS DATE) AS fecha,
               CAST(year(h) AS INTEGER) AS anio, CAST(quarter(h) AS INTEGER) AS trimestre,
               CAST(month(h) AS INTEGER) AS mes, {MONTHS_SQL}[month(h)] AS nombre_mes,
               CAST(weekofyear(h) AS INTEGER) AS semana, CAST(day(h) AS INTEGER) AS dia,
               CAST(isodow(h) AS INTEGER) AS dia_semana,
               {WEEKDAYS_SQL}[isodow(h)] AS nombre_dia, CAST(hour(h) AS INTEGER) AS hora,
               isodow(h) IN (6, 7) AS es_fin_semana
        FROM (SELECT date_trunc('hour', created_at) AS h FROM src_orders
              UNION SELECT date_trunc('hour', date) FROM src_reservations) hours
        WHERE h IS NOT NULL
        """
    ),
    "dim_usuario": with_sources(
        "SELECT id AS usuario_id, name AS nombre, role AS rol, CAST(created_at AS DATE) AS fecha_registro"
        " FROM src_users"
    ),
    "dim_restaurante": with_sources(
        "SELECT id AS restaurante_id, name AS nombre, address AS direccion, capacity AS capacidad"
        " FROM src_restaurants"
    ),
    "dim_producto": with_sources(
        "SELECT id AS producto_id, name AS nombre, category AS categoria, price AS precio_actual,"
        " available AS disponible, restaurant_id AS restaurante_id FROM src_products"
    ),
    "fact_items_pedido": on_lines(
        f"""
        SELECT {HOUR_KEY.format("ts")} AS tiempo_key, u.id AS usuario_id, r.id AS restaurante_id,
               p.id AS producto_id, pedido_id, item_id, cantidad, precio AS precio_unitario,
               monto AS monto_total, estado AS estado_pedido, pickup AS es_para_llevar
        FROM lines LEFT JOIN src_users u ON u.id = user_id
        LEFT JOIN src_restaurants r ON r.id = lines.restaurant_id
        LEFT JOIN src_products p ON p.id = product_id
        """
    ),
    "fact_reservaciones": with_sources(
        f"""
        SELECT {HOUR_KEY.format("date")} AS tiempo_key, u.id AS usuario_id,
               r.id AS restaurante_id, v.id AS reservacion_id, party_size AS tamano_grupo,
               status AS estado
        FROM src_reservations v LEFT JOIN src_users u ON u.id = user_id
        LEFT JOIN src_restaurants r ON r.id = restaurant_id
        """
    ),
    "revenue_by_month_category": on_lines("SELECT * FROM revenue", REVENUE),
    "user_activity_by_restaurant": on_lines("SELECT * FROM activity", ACTIVITY),
    "order_status_mix": on_lines("SELECT * FROM mix", STATUS),
    "consumption_ranking": on_lines("SELECT * FROM ranking", RANKING),
    "top_product_per_category": on_lines(
        "SELECT * FROM ranking WHERE ranking_en_categoria = 1", RANKING
    ),
    "peak_hours_weekday": on_lines("SELECT * FROM peaks", PEAKS),
    "busiest_slots": on_lines(
        "SELECT * FROM peaks ORDER BY total_pedidos DESC, hora, nombre_dia LIMIT 10", PEAKS
    ),
    "monthly_growth": on_lines(
        f"""
        SELECT *, {growth("ingresos_mes", "ingresos_mes_anterior")} AS crecimiento_pct
        FROM (SELECT *, LAG(ingresos_mes) OVER (ORDER BY anio, mes) AS ingresos_mes_anterior
              FROM (SELECT {MONTH_PARTS}, {money("monto")} AS ingresos_mes,
                           {count_of("pedido_id")} AS total_pedidos
                    FROM lines WHERE estado = 'confirmed' GROUP BY 1, 2, 3) months) lagged
        """
    ),
    "card_revenue_by_month_category": on_lines(
        "SELECT nombre_mes, categoria, ingresos_totales, unidades_vendidas, total_pedidos"
        " FROM revenue",
        REVENUE,
    ),
    "card_average_ticket": on_lines(
        f"""
        SELECT categoria,
               {average("CAST(ticket_promedio AS DECIMAL(18,2))")} AS ticket_promedio_general,
               {money("ingresos_totales")} AS ingresos_acumulados
        FROM revenue GROUP BY categoria
        """,
        REVENUE,
    ),
    "card_unique_users": on_lines(
        f"""
        SELECT restaurante, zona, {units("usuarios_unicos")} AS usuarios_unicos_total,
               {units("total_pedidos")} AS pedidos_total, {money("ingresos")} AS ingresos_total
        FROM activity GROUP BY 1, 2
        """,
        ACTIVITY,
    ),
    "card_monthly_activity": on_lines(
        "SELECT nombre_mes, restaurante, usuarios_unicos, total_pedidos, ingresos FROM activity",
        ACTIVITY,
    ),
    "card_orders_per_status": on_lines(
        f"""
        SELECT estado_pedido, {units("total_pedidos")} AS pedidos,
               {money("monto_total")} AS monto_total
        FROM mix GROUP BY 1
        """,
        STATUS,
    ),
    "card_status_by_month": on_lines(
        "SELECT nombre_mes, estado_pedido, total_pedidos, monto_total, porcentaje FROM mix",
        STATUS,
    ),
    "exact_average_ticket": on_lines(
        f"""
        SELECT p.category AS categoria, {average("monto")} AS ticket_promedio_general,
               {money("monto")} AS ingresos_acumulados
        FROM lines JOIN src_products p ON p.id = product_id
        WHERE estado = 'confirmed' GROUP BY 1
        """
    ),
    "exact_unique_users": on_lines(
        f"""
        SELECT r.name AS restaurante, r.address AS zona,
               {count_of("user_id")} AS usuarios_unicos_total,
               {count_of("pedido_id")} AS pedidos_total, {money("monto")} AS ingresos_total
        FROM lines JOIN src_restaurants r ON r.id = restaurant_id
        WHERE estado = 'confirmed' GROUP BY 1, 2
        """
    ),
    "unique_users_rolled_up": on_lines(
        f"""
        SELECT r.name AS restaurante, r.address AS zona,
               {count_of("user_id")} AS usuarios_unicos_total,
               {count_of("pedido_id")} AS pedidos_total, {money("monto")} AS ingresos_total
        FROM lines JOIN src_restaurants r ON r.id = restaurant_id
        WHERE estado = 'confirmed' GROUP BY 1, 2
        """
    ),
    "unique_users_per_year": on_lines(
        f"""
        SELECT CAST(year(ts) AS INTEGER) AS anio, {count_of("user_id")} AS usuarios_unicos_total,
               {count_of("pedido_id")} AS pedidos_total, {money("monto")} AS ingresos_total
        FROM lines JOIN src_restaurants r ON r.id = restaurant_id
        WHERE estado = 'confirmed' GROUP BY 1
        """
    ),
    "revenue_per_restaurant": on_lines(
        f"""
        SELECT r.name AS nombre, {money("monto")} AS ingresos
        FROM lines JOIN src_restaurants r ON r.id = restaurant_id GROUP BY 1
        """
    ),
    "orders_per_month": on_lines(
        f"""
        SELECT CAST(year(ts) AS INTEGER) AS anio, CAST(month(ts) AS INTEGER) AS mes,
               {count_of("pedido_id")} AS ordenes
        FROM lines GROUP BY 1, 2
        """
    ),
    "total_revenue": on_lines(
        f"""
        SELECT {money("monto")} AS ingresos, {count_of("pedido_id")} AS pedidos
        FROM lines WHERE estado = 'confirmed'
        """
    ),
    "best_sellers": on_lines(
        f"""
        SELECT p.id AS producto_id, p.name AS producto, p.category AS categoria,
               {units("cantidad")} AS unidades_vendidas, {money("monto")} AS ingresos
        FROM lines JOIN src_products p ON p.id = product_id
        WHERE estado = 'confirmed' GROUP BY 1, 2, 3
        ORDER BY unidades_vendidas DESC, producto_id LIMIT 10
        """
    ),
    "sales_by_hour": on_lines(
        f"""
        SELECT CAST(hour(ts) AS INTEGER) AS hora, {count_of("pedido_id")} AS total_pedidos,
               {money("monto")} AS ingresos
        FROM lines WHERE estado = 'confirmed' GROUP BY 1
        """
    ),
    "pickup_vs_delivery": on_lines(
        f"""
        SELECT pickup AS es_para_llevar, {count_of("pedido_id")} AS total_pedidos,
               {money("monto")} AS ingresos
        FROM lines GROUP BY 1
        """
    ),
    "activity_per_user": on_lines(
        f"""
        SELECT u.id AS usuario_id, u.name AS usuario, {count_of("pedido_id")} AS total_pedidos,
               {money("monto")} AS ingresos
        FROM lines JOIN src_users u ON u.id = user_id GROUP BY 1, 2
        """
    ),
    "daily_orders": on_lines(
        f"""
        SELECT CAST(ts AS DATE) AS fecha, {count_of("pedido_id")} AS total_pedidos,
               {money("monto")} AS ingresos
        FROM lines GROUP BY 1
        """
    ),
    "reservations_by_restaurant": with_sources(
        f"""
        SELECT r.name AS restaurante, r.address AS zona, COUNT(*) AS reservaciones,
               {units("party_size")} AS personas
        FROM src_reservations v JOIN src_restaurants r ON r.id = v.restaurant_id GROUP BY 1, 2
        """
    ),
    "reservations_by_group_size": with_sources(
        "SELECT party_size AS tamano_grupo, COUNT(*) AS reservaciones FROM src_reservations"
        " GROUP BY 1"
    ),
    "reservations_by_status": with_sources(
        f"""
        SELECT status AS estado, COUNT(*) AS reservaciones, {units("party_size")} AS personas
        FROM src_reservations GROUP BY 1
        """
    ),
    "fact_sales": on_lines(
        """
        SELECT pedido_id AS order_id, lines.user_id, lines.restaurant_id, lines.product_id,
               p.name AS product_name, p.category, cantidad AS quantity, precio AS unit_price,
               monto AS line_total, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
               CAST(ts AS DATE) AS order_date,
               CAST(hour(ts) AS INTEGER) AS order_hour, strftime(ts, '%Y-%m') AS order_month,
               estado AS status, 'Sin zona' AS zone, o.latitude AS delivery_latitude,
               o.longitude AS delivery_longitude
        FROM lines JOIN src_orders o ON o.id = pedido_id
        LEFT JOIN src_products p ON p.id = lines.product_id
        """
    ),
    "daily_trend": on_lines(
        f"""
        SELECT CAST(ts AS DATE) AS order_date, p.category, product_id, p.name AS product_name,
               {units("cantidad")} AS units_sold, {money("monto")} AS revenue,
               {count_of("pedido_id")} AS orders_count
        FROM lines LEFT JOIN src_products p ON p.id = product_id
        WHERE estado = 'confirmed' GROUP BY 1, 2, 3, 4
        """
    ),
    "peak_hours": on_lines(
        f"""
        SELECT CAST(hour(ts) AS INTEGER) AS order_hour, {count_of("pedido_id")} AS orders_count,
               {money("monto")} AS revenue, {units("cantidad")} AS units_sold
        FROM lines WHERE estado = 'confirmed' GROUP BY 1
        """
    ),
    "monthly_growth_flat": on_lines(
        f"""
        SELECT *, {growth("revenue", "previous_month_revenue")} AS growth_pct
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY order_month) AS previous_month_revenue
              FROM (SELECT strftime(ts, '%Y-%m') AS order_month,
                           {count_of("pedido_id")} AS orders_count, {money("monto")} AS revenue
                    FROM lines WHERE estado = 'confirmed' GROUP BY 1) months) lagged
        """
    ),
    "reservations_summary": with_sources(
        f"""
        SELECT strftime(date, '%Y-%m') AS reservation_month, status,
               COUNT(*) AS reservations_count, {units("party_size")} AS total_people
        FROM src_reservations GROUP BY 1, 2
        """
    ),
    "co_purchases": with_sources(
        "SELECT product_a_id, product_b_id, times AS times_bought_together FROM pairs",
        CO_PURCHASES,
    ),
    "top_bought_together": with_sources(
        """
        SELECT a.name AS producto_1, b.name AS producto_2, times AS veces_comprados_juntos
        FROM pairs JOIN src_products a ON a.id = product_a_id
        JOIN src_products b ON b.id = product_b_id
        ORDER BY times DESC, a.name, b.name, product_a_id, product_b_id LIMIT 5
        """,
        CO_PURCHASES,
    ),
    "influential_users": with_sources(
        """
        SELECT from_user_id AS usuario_id, u.name AS usuario,
               COUNT(*) OVER (PARTITION BY from_user_id) AS usuarios_recomendados,
               to_user_id AS recomendado_id, t.name AS recomendado
        FROM recommends JOIN src_users u ON u.id = from_user_id JOIN src_users t ON t.id = to_user_id
        """,
        RECOMMENDS,
    ),
    "active_users": with_sources(
        """
        SELECT u.id AS usuario_id, u.name AS usuario,
               COUNT(DISTINCT o.id) AS pedidos_realizados
        FROM src_orders o JOIN src_users u ON u.id = o.user_id GROUP BY 1, 2
        ORDER BY pedidos_realizados DESC, usuario, usuario_id LIMIT 10
        """
    ),
    "category_units_graph": with_sources(
        f"""
        SELECT p.category AS categoria, {units("quantity")} AS unidades,
               {money("line_total")} AS ingresos
        FROM contains JOIN src_products p ON p.id = product_id GROUP BY 1
        """,
        CONTAINS,
    ),
    "graph_placed": with_sources(
        "SELECT DISTINCT o.user_id, o.id AS order_id FROM src_orders o"
        " JOIN src_users u ON u.id = o.user_id"
    ),
    "graph_contains": with_sources("SELECT * FROM contains", CONTAINS),
    "graph_recommends": with_sources("SELECT * FROM recommends", RECOMMENDS),
    "graph_sample_purchases": with_sources(
        """
        SELECT o.user_id, o.id AS order_id, c.product_id
        FROM src_orders o JOIN src_users u ON u.id = o.user_id
        JOIN contains c ON c.order_id = o.id ORDER BY 1, 2, 3 LIMIT 50
        """,
        CONTAINS,
    ),
    "graph_sample_bought_together": with_sources(
        """
        SELECT product_a_id, product_b_id, times
        FROM pairs JOIN src_products a ON a.id = product_a_id
        JOIN src_products b ON b.id = product_b_id
        ORDER BY times DESC, product_a_id, product_b_id LIMIT 30
        """,
        CO_PURCHASES,
    ),
    "graph_sample_recommendations": with_sources(
        "SELECT * FROM recommends ORDER BY from_user_id, to_user_id LIMIT 30", RECOMMENDS
    ),
    "graph_sample_deliveries": on_routes(
        "SELECT order_id, location_id FROM routes ORDER BY 1, 2 LIMIT 50"
    ),
    "graph_sample_stops": on_routes(
        "SELECT * FROM stop_rows ORDER BY repartidor, parada LIMIT 60", STOP_ROWS
    ),
    "graph_sample_legs": on_routes("SELECT * FROM legs ORDER BY repartidor, parada LIMIT 60"),
    "graph_sample_paths": on_routes(
        """
        SELECT hops, array_to_string(nodes, ' > ') AS path
        FROM walk ORDER BY hops, nodes, used LIMIT 20
        """,
        _paths(5),
    ),
    "courier_queue": with_sources("SELECT order_id, ordinal, courier FROM stops", QUEUE),
    "depot_distances": with_sources(
        f"""
        SELECT order_id, '{DEFAULT_ZONE}' AS zone,
               round({_great_circle(f"{DEPOT_LATITUDE}::DOUBLE", f"{DEPOT_LONGITUDE}::DOUBLE", "latitude", "longitude")}, 3)
                 AS distance_km
        FROM routable
        """,
        QUEUE,
    ),
    "shift_queue": with_sources("SELECT order_id, shift, place AS ordinal, own AS courier FROM shift_stops", SHIFT_QUEUE),
    "shift_assignments": with_sources(
        f"""
        SELECT s.shift, '{COURIER_PREFIX}' || (s.own + 1) AS courier_id,
               {ROUTE_COLUMNS.removeprefix("courier_id, ").replace("order_id, user_id", "r.order_id, r.user_id").replace("latitude, longitude", "r.latitude, r.longitude")}
        FROM routes r JOIN stops s ON s.order_id = r.order_id
        """,
        SHIFT_QUEUE, TOUR, recursive=True,
    ),
    "route_assignments": on_routes(f"SELECT {ROUTE_COLUMNS} FROM routes"),
    "route_edges": on_routes("SELECT * FROM edges"),
    "route_stops": on_routes("SELECT * FROM stop_rows", STOP_ROWS),
    "courier_workload": on_routes(
        """
        SELECT courier_id AS repartidor, COUNT(*) AS pedidos_asignados,
               round(SUM(distance_from_previous_km), 3) AS distancia_total_km,
               round(SUM(estimated_minutes), 2) AS tiempo_total_min
        FROM routes GROUP BY 1
        """
    ),
    "courier_assignments": on_routes("SELECT DISTINCT courier_id, order_id FROM routes"),
    "route_legs": on_routes("SELECT * FROM legs"),
    "delivery_locations": on_routes("SELECT * FROM places"),
    "shortest_paths_from_depot": on_routes(
        """
        SELECT list_last(names) AS destino, array_to_string(names, ' > ') AS ruta,
               CAST(km AS DOUBLE) AS distancia_total_km, CAST(minutes AS DOUBLE) AS tiempo_total_min
        FROM (SELECT km, minutes, hops, here,
                     (SELECT list(p.name ORDER BY pos)
                      FROM (SELECT unnest(best.nodes) AS node,
                                   generate_subscripts(best.nodes, 1) AS pos) n
                      JOIN places p ON p.location_id = n.node) AS names
              FROM (SELECT * FROM walk ORDER BY km, hops, here, used LIMIT 5) best) named
        """,
        _paths(8),
    ),
    "row_counts": on_lines(
        """
        SELECT 'dim_tiempo' AS tabla, COUNT(*) AS filas
        FROM (SELECT date_trunc('hour', created_at) FROM src_orders
              UNION SELECT date_trunc('hour', date) FROM src_reservations) hours
        UNION ALL SELECT 'dim_usuario', COUNT(*) FROM src_users
        UNION ALL SELECT 'dim_restaurante', COUNT(*) FROM src_restaurants
        UNION ALL SELECT 'dim_producto', COUNT(*) FROM src_products
        UNION ALL SELECT 'fact_items_pedido', COUNT(*) FROM lines
        UNION ALL SELECT 'fact_reservaciones', COUNT(*) FROM src_reservations
        """
    ),
    "dangling_keys": on_lines(
        """
        SELECT 'fact_items_pedido' AS tabla, 'tiempo_key' AS llave,
               COUNT(*) FILTER (ts IS NULL) AS sin_miembro FROM lines
        UNION ALL SELECT 'fact_items_pedido', 'usuario_key', COUNT(*) FROM lines
          WHERE user_id IS NULL OR user_id NOT IN (SELECT id FROM known_users)
        UNION ALL SELECT 'fact_items_pedido', 'restaurante_key', COUNT(*) FROM lines
          WHERE restaurant_id IS NULL OR restaurant_id NOT IN (SELECT id FROM known_restaurants)
        UNION ALL SELECT 'fact_items_pedido', 'producto_key', COUNT(*) FROM lines
          WHERE product_id IS NULL OR product_id NOT IN (SELECT id FROM known_products)
        UNION ALL SELECT 'fact_reservaciones', 'tiempo_key', COUNT(*) FILTER (date IS NULL)
          FROM src_reservations
        UNION ALL SELECT 'fact_reservaciones', 'usuario_key', COUNT(*) FROM src_reservations
          WHERE user_id IS NULL OR user_id NOT IN (SELECT id FROM known_users)
        UNION ALL SELECT 'fact_reservaciones', 'restaurante_key', COUNT(*) FROM src_reservations
          WHERE restaurant_id IS NULL OR restaurant_id NOT IN (SELECT id FROM known_restaurants)
        """,
        "known_users AS (SELECT id FROM src_users)",
        "known_restaurants AS (SELECT id FROM src_restaurants)",
        "known_products AS (SELECT id FROM src_products)",
    ),
    "repeated_lines": with_sources(
        "SELECT order_id, product_id, COUNT(*) AS filas FROM src_items GROUP BY 1, 2"
        " HAVING COUNT(*) > 1"
    ),
    "uniqueness_violations": on_routes(
        """
        SELECT 'users' AS etiqueta, '["' || id || '"]' AS clave, CAST(2 AS BIGINT) AS filas
        FROM src_users WHERE CAST(id AS BIGINT) % 5 = 0
        UNION ALL SELECT 'products', '["' || id || '"]', 2 FROM src_products
        WHERE CAST(id AS BIGINT) % 7 = 0
        UNION ALL SELECT 'orders', '["' || id || '"]', 2 FROM src_orders
        WHERE CAST(id AS BIGINT) % 11 = 0
        UNION ALL SELECT 'locations', '["' || location_id || '"]', 2 FROM places
        WHERE CAST(nullif(regexp_extract(location_id, '[0-9]+$'), '') AS BIGINT) % 13 = 0
        UNION ALL SELECT DISTINCT 'couriers', '["' || courier_id || '"]', 2 FROM routes
        WHERE CAST(regexp_extract(courier_id, '[0-9]+$') AS BIGINT) % 3 = 0
        UNION ALL SELECT 'stops', '["' || courier_id || '","' || stop_order || '"]', 2 FROM routes
        WHERE CAST(regexp_extract(courier_id, '[0-9]+$') AS BIGINT) % 4 = 0
        """
    ),
    "catalogue_fingerprint": with_sources(
        """
        SELECT COUNT(*) AS filas,
               CAST(coalesce(SUM(CAST(('0x' || substr(h, 1, 15))::BIGINT AS HUGEINT)), 0) AS VARCHAR) AS suma,
               CAST(coalesce(SUM(CAST(('0x' || substr(h, 16, 15))::BIGINT AS HUGEINT)), 0) AS VARCHAR) AS suma_2
        FROM (SELECT md5(string_agg(CAST(length(v) AS VARCHAR) || ':' || v, '' ORDER BY i)) AS h
              FROM (SELECT id, unnest([1, 2, 3, 4, 5]) AS i,
                           unnest([id, coalesce(name, '\\N'), coalesce(category, '\\N'),
                                   coalesce(CAST(price AS VARCHAR), '\\N'),
                                   coalesce(CAST(available AS VARCHAR), '\\N')]) AS v
                    FROM src_products) parts
              GROUP BY id) digests
        """
    ),
    "graph_node_users": with_sources("SELECT id AS user_id, name, zone FROM src_users"),
    "graph_node_products": with_sources(
        "SELECT id AS product_id, name, category, price FROM src_products"
    ),
    "graph_node_orders": with_sources(
        "SELECT id AS order_id, restaurant_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,"
        " status, 'Sin zona' AS zone FROM src_orders"
    ),
    "graph_node_locations": on_routes("SELECT * FROM places"),
    "graph_node_couriers": on_routes("SELECT DISTINCT courier_id FROM routes"),
    "graph_node_stops": on_routes(
        "SELECT courier_id, stop_order, zone, distance_from_previous_km, estimated_minutes,"
        " accumulated_km FROM routes"
    ),
    "graph_edge_bought_together": with_sources(
        """
        SELECT product_a_id, product_b_id, times
        FROM pairs JOIN src_products a ON a.id = product_a_id JOIN src_products b ON b.id = product_b_id
        """,
        CO_PURCHASES,
    ),
    "graph_edge_has_stop": on_routes("SELECT courier_id, stop_order FROM routes"),
    "graph_edge_delivers_order": on_routes("SELECT courier_id, stop_order, order_id FROM routes"),
    "graph_edge_delivers_to": on_routes("SELECT order_id, location_id FROM routes"),
    "graph_edge_route_to": on_routes("SELECT * FROM edges"),
    "catalogue_changes": with_sources(
        """
        SELECT coalesce(o.id, n.id) AS id,
               CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed'
                    ELSE 'changed' END AS change,
               o.name AS name_old, n.name AS name_new, o.category AS category_old,
               n.category AS category_new, o.price AS price_old, n.price AS price_new,
               o.available AS available_old, n.available AS available_new
        FROM src_products o FULL OUTER JOIN later n ON n.id = o.id
        WHERE o.id IS NULL OR n.id IS NULL OR o.name IS DISTINCT FROM n.name
           OR o.category IS DISTINCT FROM n.category OR o.price IS DISTINCT FROM n.price
           OR o.available IS DISTINCT FROM n.available
        """,
        PERTURBED,
    ),
    "upsert_products": with_sources(
        """
        SELECT id, name, category, price FROM later
        UNION ALL
        SELECT id, name, category, price FROM src_products
        WHERE id NOT IN (SELECT id FROM later)
        """,
        PERTURBED,
    ),
    "extract_orders_with_items": with_sources(
        """
        SELECT CAST(o.id AS BIGINT) AS order_id, CAST(o.user_id AS BIGINT) AS user_id,
               CAST(o.restaurant_id AS BIGINT) AS restaurant_id, o.total,
               o.status AS order_status, o.reservation_id,
               o.pickup, strftime(o.created_at, '%Y-%m-%d %H:%M:%S') AS order_created_at,
               i.id AS item_id, CAST(i.product_id AS BIGINT) AS product_id, i.quantity, i.price AS item_price
        FROM src_orders o JOIN src_items i ON i.order_id = o.id
        """
    ),
    "extract_reservations": with_sources(
        """
        SELECT CAST(id AS BIGINT) AS id, CAST(restaurant_id AS BIGINT) AS restaurant_id,
               CAST(user_id AS BIGINT) AS user_id, strftime(date, '%Y-%m-%d %H:%M:%S') AS date,
               party_size, status, strftime(date, '%Y-%m-%d %H:%M:%S') AS created_at
        FROM src_reservations
        """
    ),
    "extract_users": with_sources(
        "SELECT CAST(id AS BIGINT) AS id, name, role,"
        " strftime(created_at, '%Y-%m-%d %H:%M:%S') AS fecha_registro FROM src_users"
    ),
    "extract_restaurants": with_sources(
        "SELECT CAST(id AS BIGINT) AS id, name, address, capacity FROM src_restaurants"
    ),
    "extract_products": with_sources(
        "SELECT CAST(id AS BIGINT) AS id, name, category, price, available,"
        " CAST(restaurant_id AS BIGINT) AS restaurant_id FROM src_products"
    ),
}

# Results that other entries name as well.
ORACLES |= {
    f"warehouse_{name}": ORACLES[name]
    for name in (
        "revenue_by_month_category", "user_activity_by_restaurant", "order_status_mix",
        "consumption_ranking", "peak_hours_weekday", "monthly_growth", "reservations_by_restaurant",
    )
}
ORACLES |= {
    "exchange_users": with_sources("SELECT id AS user_id, name, zone FROM src_users"),
    "exchange_products": with_sources("SELECT id AS product_id, name, category, price FROM src_products"),
    "exchange_orders": with_sources(
        f"""
        SELECT id AS order_id, user_id, restaurant_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
               status, '{DEFAULT_ZONE}' AS zone
        FROM src_orders
        """
    ),
    "exchange_order_items": with_sources(
        "SELECT order_id, product_id, quantity, price AS unit_price FROM src_items"
    ),
    "exchange_recommendations": with_sources(
        "SELECT referred_by AS from_user_id, id AS to_user_id FROM src_users WHERE referred_by IS NOT NULL"
    ),
    "exchange_co_purchases": with_sources(
        "SELECT product_a_id, product_b_id, times AS times_bought_together FROM pairs", CO_PURCHASES
    ),
    "exchange_locations": on_routes("SELECT * FROM places"),
    "exchange_route_assignments": ORACLES["route_assignments"],
    "exchange_route_edges": ORACLES["route_edges"],
}
