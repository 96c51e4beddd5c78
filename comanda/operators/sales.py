"""The flat sales fact and its analyses, for sources without a star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.constants import SOLD_IN_SALES
from comanda.functions.keys import one_per_key
from comanda.functions.numbers import growth_percent, line_amount, money_sum
from comanda.sources.tables import Tables


def order_lines(data: Tables) -> DataFrame:
    """One row per item with its order.

    Orders without items and items without an order drop out. Lines that were
    written down are taken as they are.
    """
    written = getattr(data, "order_lines", None)
    if written is not None:
        return written
    created = F.col("created_at")
    return data.order_items.join(data.orders, "order_id").select(
        "order_id",
        "user_id",
        "restaurant_id",
        "product_id",
        "quantity",
        "unit_price",
        line_amount(F.col("quantity"), F.col("unit_price")).alias("line_total"),
        "created_at",
        F.to_date(created).alias("order_date"),
        F.hour(created).alias("order_hour"),
        F.date_format(created, "yyyy-MM").alias("order_month"),
        "status",
        "zone",
        "delivery_latitude",
        "delivery_longitude",
    )


def _product_names(data: Tables) -> DataFrame:
    named = data.products.select("product_id", F.col("name").alias("product_name"), "category")
    return one_per_key(named, "product_id")


def fact_sales(data: Tables) -> DataFrame:
    """Order lines with their product; unknown products have no name.

    A product listed twice counts once.
    """
    joined = order_lines(data).join(_product_names(data), "product_id", "left")
    first = ("order_id", "user_id", "restaurant_id", "product_id", "product_name", "category")
    return joined.select(*first, *[c for c in joined.columns if c not in first])


def _sold(data: Tables, sold: Sequence[str]) -> DataFrame:
    return order_lines(data).where(F.col("status").isin(*sold))


def _units():
    return F.sum("quantity").alias("units_sold")


def _revenue():
    return money_sum("line_total").alias("revenue")


def _orders():
    return F.countDistinct("order_id").alias("orders_count")


def consumption_trends(data: Tables, sold: Sequence[str] = SOLD_IN_SALES) -> DataFrame:
    """Sales per day and product, named after they are summed."""
    daily = _sold(data, sold).groupBy("order_date", "product_id").agg(
        _units(), _revenue(), _orders()
    )
    return (
        daily.join(_product_names(data), "product_id", "left")
        .select(
            "order_date", "category", "product_id", "product_name",
            "units_sold", "revenue", "orders_count",
        )
        .orderBy("order_date", F.desc("revenue"), "product_id")
    )


def peak_hours(data: Tables, sold: Sequence[str] = SOLD_IN_SALES) -> DataFrame:
    return (
        _sold(data, sold)
        .where(F.col("order_hour").isNotNull())
        .groupBy("order_hour")
        .agg(_orders(), _revenue(), _units())
        .orderBy(F.desc("orders_count"), F.desc("revenue"), "order_hour")
    )


def monthly_growth(data: Tables, sold: Sequence[str] = SOLD_IN_SALES) -> DataFrame:
    """The window runs over one row per month."""
    months = (
        _sold(data, sold)
        .where(F.col("order_month").isNotNull())
        .groupBy("order_month")
        .agg(_orders(), _revenue())
    )
    previous = F.lag("revenue").over(Window.orderBy("order_month"))
    return (
        months.withColumn("previous_month_revenue", previous)
        .withColumn(
            "growth_pct", growth_percent(F.col("revenue"), F.col("previous_month_revenue"))
        )
        .orderBy("order_month")
    )


def reservations_summary(reservations: DataFrame) -> DataFrame:
    return (
        reservations.groupBy(
            F.date_format("reservation_time", "yyyy-MM").alias("reservation_month"), "status"
        )
        .agg(
            F.count(F.lit(1)).alias("reservations_count"),
            F.sum("party_size").alias("total_people"),
        )
        .orderBy("reservation_month", "status")
    )
