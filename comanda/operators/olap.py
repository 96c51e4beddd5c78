"""Analytical views over the star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.constants import SOLD_IN_STAR
from comanda.functions.numbers import growth_percent, money_avg, money_sum, percent_of
from comanda.operators.ordinal import with_ordinal
from comanda.operators.ranking import rank_within
from comanda.operators.star import Star

MONTH = ("anio", "mes", "nombre_mes")


def _items(star: Star, sold: Sequence[str] | None = None) -> DataFrame:
    fact = star.fact_items_pedido
    return fact.where(F.col("estado_pedido").isin(*sold)) if sold else fact


def _with(star: Star, fact: DataFrame, dim: str) -> DataFrame:
    """Inner join with a dimension: facts of unknown members drop out."""
    if dim == "tiempo":
        return star.with_calendar(fact)
    table = getattr(star, f"dim_{dim}")
    key = star.key(dim)
    clashes = [c for c in table.columns if c in fact.columns and c != key]
    return fact.join(table.drop(*clashes), key)


def _sold_by_time(star: Star, sold: Sequence[str]) -> DataFrame:
    return _with(star, _items(star, sold), "tiempo")


def revenue_by_month_category(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """``ticket_promedio`` averages order lines, not orders."""
    return (
        _with(star, _sold_by_time(star, sold), "producto")
        .groupBy(*MONTH, "categoria")
        .agg(
            F.countDistinct("pedido_id").alias("total_pedidos"),
            F.sum("cantidad").alias("unidades_vendidas"),
            money_sum("monto_total").alias("ingresos_totales"),
            money_avg("monto_total").alias("ticket_promedio"),
        )
    )


def _activity(star: Star, lines: DataFrame, *time: str) -> DataFrame:
    """Distinct users and orders per restaurant name, address and ``time``.

    An order has one user and one restaurant, so counting orders per user and
    then users and orders is exact, without a distinct over either. Lines are
    summed per order before restaurants are named.
    """
    user, place = star.key("usuario"), star.key("restaurante")
    per_order = lines.groupBy(*time, place, user, "pedido_id").agg(F.sum("monto_total").alias("monto"))
    per_user = per_order.groupBy(*time, place, user).agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum("monto").alias("monto")
    )
    named = _with(star, per_user, "restaurante").withColumnsRenamed(
        {"nombre": "restaurante", "direccion": "zona"}
    )
    group = ("restaurante", "zona", *time)
    # Restaurants of one name and address are one.
    once = named.groupBy(*group, user).agg(F.sum("pedidos").alias("pedidos"), F.sum("monto").alias("monto"))
    return once.groupBy(*group).agg(
        F.count(user).alias("usuarios_unicos"),
        F.sum("pedidos").alias("total_pedidos"),
        money_sum("monto").alias("ingresos"),
    )


def user_activity_by_restaurant(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """Distinct users and orders per restaurant name, address and month."""
    return _activity(star, _sold_by_time(star, sold), *MONTH)


def order_status_mix(star: Star) -> DataFrame:
    """Orders, amount and share per status within each month; all statuses."""
    month = Window.partitionBy("anio", "mes")
    return (
        _with(star, _items(star), "tiempo")
        .groupBy(*MONTH, "estado_pedido")
        .agg(
            F.countDistinct("pedido_id").alias("total_pedidos"),
            money_sum("monto_total").alias("monto_total"),
        )
        .withColumn(
            "porcentaje",
            percent_of(F.col("total_pedidos"), F.sum("total_pedidos").over(month)),
        )
    )


def consumption_ranking(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """Products ranked by units within month and category.

    Lines are summed per product before products are named, then per name:
    equal names in a category are one product.
    """
    per_key = (
        _sold_by_time(star, sold)
        .groupBy(*MONTH, star.key("producto"))
        .agg(F.sum("cantidad").alias("unidades"), F.sum("monto_total").alias("monto"))
    )
    sales = (
        _with(star, per_key, "producto")
        .groupBy(*MONTH, "categoria", F.col("nombre").alias("producto"))
        .agg(
            F.sum("unidades").alias("unidades_vendidas"),
            money_sum("monto").alias("ingresos"),
        )
    )
    return rank_within(
        sales, ("anio", "mes", "categoria"), "unidades_vendidas", "ranking_en_categoria"
    )


def top_product_per_category(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    return consumption_ranking(star, sold).where(F.col("ranking_en_categoria") == 1)


def peak_hours_weekday(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    return (
        _sold_by_time(star, sold)
        .groupBy("hora", "nombre_dia", "es_fin_semana")
        .agg(
            F.countDistinct("pedido_id").alias("total_pedidos"),
            F.sum("cantidad").alias("unidades_vendidas"),
            money_sum("monto_total").alias("ingresos"),
            money_avg("monto_total").alias("ticket_promedio"),
        )
    )


def busiest_slots(star: Star, sold: Sequence[str] = SOLD_IN_STAR, k: int = 10) -> DataFrame:
    order = (F.desc("total_pedidos"), F.asc("hora"), F.asc("nombre_dia"))
    return peak_hours_weekday(star, sold).orderBy(*order).limit(k)


def monthly_growth(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """Revenue against the previous month that has any.

    The window is not partitioned, but runs over one row per month.
    """
    months = (
        _sold_by_time(star, sold)
        .groupBy(*MONTH)
        .agg(
            money_sum("monto_total").alias("ingresos_mes"),
            F.countDistinct("pedido_id").alias("total_pedidos"),
        )
    )
    previous = F.lag("ingresos_mes").over(Window.orderBy("anio", "mes"))
    return (
        months.withColumn("ingresos_mes_anterior", previous)
        .withColumn(
            "crecimiento_pct",
            growth_percent(F.col("ingresos_mes"), F.col("ingresos_mes_anterior")),
        )
        .orderBy("anio", "mes")
    )


# Dashboard cards ----------------------------------------------------------


def card_revenue_by_month_category(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    return (
        revenue_by_month_category(star, sold)
        .orderBy("anio", "mes", "categoria")
        .select(
            "nombre_mes", "categoria", "ingresos_totales", "unidades_vendidas", "total_pedidos"
        )
    )


def card_average_ticket(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """Averages the monthly averages; ``exact_average_ticket`` does not."""
    ticket = F.col("ticket_promedio").cast("decimal(18,2)")
    return (
        revenue_by_month_category(star, sold)
        .groupBy("categoria")
        .agg(
            money_avg(ticket).alias("ticket_promedio_general"),
            money_sum("ingresos_totales").alias("ingresos_acumulados"),
        )
        .orderBy(F.desc("ingresos_acumulados"), "categoria")
    )


def exact_average_ticket(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """Average order line per category over all months."""
    return (
        _with(star, _sold_by_time(star, sold), "producto")
        .groupBy("categoria")
        .agg(
            money_avg("monto_total").alias("ticket_promedio_general"),
            money_sum("monto_total").alias("ingresos_acumulados"),
        )
        .orderBy(F.desc("ingresos_acumulados"), "categoria")
    )


def card_unique_users(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """Sums monthly distinct users; ``exact_unique_users`` counts each once."""
    return (
        user_activity_by_restaurant(star, sold)
        .groupBy("restaurante", "zona")
        .agg(
            F.sum("usuarios_unicos").alias("usuarios_unicos_total"),
            F.sum("total_pedidos").alias("pedidos_total"),
            money_sum("ingresos").alias("ingresos_total"),
        )
        .orderBy(F.desc("pedidos_total"), "restaurante", "zona")
    )


def exact_unique_users(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    lines = _items(star, sold).where(F.col("tiempo_key").isNotNull())
    return (
        _activity(star, lines)
        .withColumnsRenamed(
            {
                "usuarios_unicos": "usuarios_unicos_total",
                "total_pedidos": "pedidos_total",
                "ingresos": "ingresos_total",
            }
        )
        .orderBy(F.desc("pedidos_total"), "restaurante", "zona")
    )


def monthly_users(star: Star, members: DataFrame | None = None, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    """User activity per restaurant and month, of which months add up exactly.

    Users are bits of a bitmap, of which a row has a word of 64: rows are as small
    as a sum's, and at most as many as there are users of a restaurant and month,
    however few of all users these are. Orders and
    revenue stand beside, where an order is of one month. ``members`` numbers
    the users densely from 0, as (user's key, ordinal); a table that is carried
    on must keep its numbers. A month's new rows are found from its lines alone.
    Orders without a user count in a row of no word.
    """
    user, place = star.key("usuario"), star.key("restaurante")
    lines = _sold_by_time(star, sold)
    per_order = lines.groupBy(*MONTH, place, user, "pedido_id").agg(F.sum("monto_total").alias("monto"))
    per_user = per_order.groupBy(*MONTH, place, user).agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum("monto").alias("monto")
    )
    if members is None:
        members = with_ordinal(lines.select(user).where(F.col(user).isNotNull()).distinct(), [user])
    numbered = _with(star, per_user, "restaurante").join(members, user, "left")
    return numbered.groupBy(
        F.col("nombre").alias("restaurante"), F.col("direccion").alias("zona"), *MONTH,
        F.expr("ordinal div 64").alias("palabra"),
    ).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(ordinal % 64 as int))")).alias("usuarios"),
        F.sum("pedidos").alias("total_pedidos"),
        money_sum("monto").alias("ingresos"),
    )


def users_rolled_up(monthly: DataFrame, *by: str) -> DataFrame:
    """Distinct users, orders and revenue ``by`` any columns of ``monthly_users``, exact, without its lines."""
    words = monthly.groupBy(*by, "palabra").agg(
        F.bit_or("usuarios").alias("usuarios"),
        F.sum("total_pedidos").alias("total_pedidos"),
        money_sum("ingresos").alias("ingresos"),
    )
    return words.groupBy(*by).agg(
        F.sum(F.coalesce(F.bit_count("usuarios"), F.lit(0)).cast("long")).alias("usuarios_unicos_total"),
        F.sum("total_pedidos").alias("pedidos_total"),
        money_sum("ingresos").alias("ingresos_total"),
    )


def card_monthly_activity(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    return (
        user_activity_by_restaurant(star, sold)
        .orderBy("anio", "mes", "restaurante", "zona")
        .select("nombre_mes", "restaurante", "usuarios_unicos", "total_pedidos", "ingresos")
    )


def card_orders_per_status(star: Star) -> DataFrame:
    return (
        order_status_mix(star)
        .groupBy("estado_pedido")
        .agg(
            F.sum("total_pedidos").alias("pedidos"),
            money_sum("monto_total").alias("monto_total"),
        )
        .orderBy(F.desc("pedidos"), "estado_pedido")
    )


def card_status_by_month(star: Star) -> DataFrame:
    return (
        order_status_mix(star)
        .orderBy("anio", "mes", "estado_pedido")
        .select("nombre_mes", "estado_pedido", "total_pedidos", "monto_total", "porcentaje")
    )


# Ad-hoc questions ---------------------------------------------------------


def revenue_per_restaurant(star: Star) -> DataFrame:
    """All statuses; restaurants of one name are one."""
    per_key = _items(star).groupBy(star.key("restaurante")).agg(F.sum("monto_total").alias("monto"))
    return (
        _with(star, per_key, "restaurante")
        .groupBy("nombre")
        .agg(money_sum("monto").alias("ingresos"))
        .orderBy(F.desc("ingresos"), "nombre")
    )


def orders_per_month(star: Star) -> DataFrame:
    return (
        _with(star, _items(star), "tiempo")
        .groupBy("anio", "mes")
        .agg(F.countDistinct("pedido_id").alias("ordenes"))
        .orderBy("anio", "mes")
    )


def total_revenue(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    return _items(star, sold).agg(
        money_sum("monto_total").alias("ingresos"),
        F.countDistinct("pedido_id").alias("pedidos"),
    )


def best_sellers(star: Star, sold: Sequence[str] = SOLD_IN_STAR, k: int = 10) -> DataFrame:
    """The k products with most units; ties by product id."""
    sales = (
        _items(star, sold)
        .groupBy(star.key("producto"))
        .agg(
            F.sum("cantidad").alias("unidades_vendidas"),
            money_sum("monto_total").alias("ingresos"),
        )
    )
    return (
        sales.join(star.dim_producto, star.key("producto"))
        .select(
            "producto_id",
            F.col("nombre").alias("producto"),
            "categoria",
            "unidades_vendidas",
            "ingresos",
        )
        .orderBy(F.desc("unidades_vendidas"), "producto_id")
        .limit(k)
    )


def sales_by_hour(star: Star, sold: Sequence[str] = SOLD_IN_STAR) -> DataFrame:
    return (
        _sold_by_time(star, sold)
        .groupBy("hora")
        .agg(
            F.countDistinct("pedido_id").alias("total_pedidos"),
            money_sum("monto_total").alias("ingresos"),
        )
        .orderBy("hora")
    )


def pickup_vs_delivery(star: Star) -> DataFrame:
    return (
        _items(star)
        .groupBy("es_para_llevar")
        .agg(
            F.countDistinct("pedido_id").alias("total_pedidos"),
            money_sum("monto_total").alias("ingresos"),
        )
        .orderBy("es_para_llevar")
    )


def activity_per_user(star: Star) -> DataFrame:
    """Orders and spending per known user; summed before the user join."""
    per_user = (
        _items(star)
        .groupBy(star.key("usuario"))
        .agg(
            F.countDistinct("pedido_id").alias("total_pedidos"),
            money_sum("monto_total").alias("ingresos"),
        )
    )
    return per_user.join(star.dim_usuario, star.key("usuario")).select(
        "usuario_id", F.col("nombre").alias("usuario"), "total_pedidos", "ingresos"
    )


def daily_orders(star: Star) -> DataFrame:
    return (
        _with(star, _items(star), "tiempo")
        .groupBy("fecha")
        .agg(
            F.countDistinct("pedido_id").alias("total_pedidos"),
            money_sum("monto_total").alias("ingresos"),
        )
        .orderBy("fecha")
    )


def reservations_by_restaurant(star: Star) -> DataFrame:
    """Counted per key first, then named."""
    per_key = star.fact_reservaciones.groupBy(star.key("restaurante")).agg(
        F.count(F.lit(1)).alias("_reservaciones"), F.sum("tamano_grupo").alias("_personas")
    )
    return (
        per_key.join(star.dim_restaurante, star.key("restaurante"))
        .groupBy(F.col("nombre").alias("restaurante"), F.col("direccion").alias("zona"))
        .agg(
            F.sum("_reservaciones").alias("reservaciones"), F.sum("_personas").alias("personas")
        )
        .orderBy(F.desc("reservaciones"), "restaurante", "zona")
    )


def reservations_by_group_size(star: Star) -> DataFrame:
    return (
        star.fact_reservaciones.groupBy("tamano_grupo")
        .agg(F.count(F.lit(1)).alias("reservaciones"))
        .orderBy("tamano_grupo")
    )


def reservations_by_status(star: Star) -> DataFrame:
    return (
        star.fact_reservaciones.groupBy("estado")
        .agg(
            F.count(F.lit(1)).alias("reservaciones"), F.sum("tamano_grupo").alias("personas")
        )
        .orderBy("estado")
    )


# Names under which the views are registered for SQL users.
VIEWS = {
    "olap_ingresos_por_mes_categoria": revenue_by_month_category,
    "olap_actividad_usuarios_por_restaurante": user_activity_by_restaurant,
    "olap_estado_pedidos": order_status_mix,
    "olap_tendencias_consumo": consumption_ranking,
    "olap_horarios_pico": peak_hours_weekday,
    "olap_crecimiento_mensual": monthly_growth,
}


def register_views(star: Star) -> None:
    """Offer the six views to ``spark.sql``; they store nothing."""
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
