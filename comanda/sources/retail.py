"""Read a wholesale schema (orders, lineitem, part, ...) as operational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.constants import DEPOT_LATITUDE, DEPOT_LONGITUDE, UNKNOWN_STATUS
from comanda.schemas import MONEY
from comanda.sources.tables import Tables

# Order status by code; open orders differ by priority.
STATUS_OF = {"F": "confirmed", "P": "cancelled", "O": "pending"}
OPEN_STATUS_OF = {"4-NOT SPECIFIED": "in_progress", "5-LOW": "completed"}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _restaurant_of(spark: SparkSession, folder: str, number: Column) -> Column:
    """A number dealt over all suppliers, whose keys count from 0."""
    suppliers = _table(spark, folder, "supplier").agg(F.count(F.lit(1)))
    return F.pmod(number, suppliers.scalar())


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    """25 rows whatever the scale."""
    return F.broadcast(_table(spark, folder, "nation").select("n_nationkey", "n_name"))


def _users(spark: SparkSession, folder: str) -> DataFrame:
    customer = _table(spark, folder, "customer")
    nation = _nations(spark, folder)
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("role"),
        F.col("n_name").alias("zone"),
        F.date_add(F.lit("1992-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int"))
        .cast("timestamp")
        .alias("created_at"),
        F.when(F.col("c_custkey") % 2 == 1, F.expr("c_custkey div 3")).alias("referred_by"),
    )


def _restaurants(spark: SparkSession, folder: str) -> DataFrame:
    supplier = _table(spark, folder, "supplier")
    nation = _nations(spark, folder)
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("address"),
        (F.col("s_suppkey") % 40 + 10).cast("int").alias("capacity"),
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        (F.col("p_size") > 5).alias("available"),
        _restaurant_of(spark, folder, F.col("p_partkey")).alias("restaurant_id"),
    )


def _codes(statuses: Sequence[str]) -> list[str]:
    """The raw codes under which orders of the given statuses are found."""
    codes = [code for code, name in STATUS_OF.items() if name in statuses]
    if set(OPEN_STATUS_OF.values()) & set(statuses):
        codes.append("O")
    return sorted(set(codes))


def _orders(spark: SparkSession, folder: str, statuses: Sequence[str] | None) -> DataFrame:
    def offset(multiplier: int) -> Column:
        return ((F.col("o_custkey") * multiplier) % 1000 - 500) / F.lit(5000.0)

    code, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    status = F
    for name, meaning in OPEN_STATUS_OF.items():
        status = status.when((code == "O") & (priority == name), meaning)
    for name, meaning in STATUS_OF.items():
        status = status.when(code == name, meaning)
    hour = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    orders = _table(spark, folder, "orders")
    if statuses is not None:
        # On the raw column, so that the scan itself leaves the others out.
        orders = orders.where(code.isin(*_codes(statuses)))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        _restaurant_of(spark, folder, F.col("o_orderkey") * 7 + F.col("o_custkey")).alias("restaurant_id"),
        F.when(F.col("o_orderkey") % 10 == 0, F.col("o_orderkey")).alias("reservation_id"),
        status.otherwise(UNKNOWN_STATUS).alias("status"),
        priority.isin("1-URGENT", "2-HIGH").alias("pickup"),
        (F.col("o_orderdate").cast("timestamp") + hour).alias("created_at"),
        F.col("o_totalprice").cast(MONEY).alias("total"),
        (F.lit(DEPOT_LATITUDE) + offset(37)).alias("delivery_latitude"),
        (F.lit(DEPOT_LONGITUDE) + offset(91)).alias("delivery_longitude"),
    )


def _order_items(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
    )


def _reservations(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    party = F.get_json_object("props", "$.k").try_cast("int")
    return _table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        _restaurant_of(spark, folder, F.col("user_id")).alias("restaurant_id"),
        ts.alias("date"),
        (1 + party % 8).alias("party_size"),
        F.col("event_type").alias("status"),
        ts.alias("created_at"),
    )


def read(spark: SparkSession, folder: str, statuses: Sequence[str] | None = None) -> Tables:
    """The operational tables; each is read when a query first needs it.

    With ``statuses``, orders are at least narrowed to those; a query that
    filters on them itself then reads no more than it must.
    """
    return Tables(
        users=lambda: _users(spark, folder),
        products=lambda: _products(spark, folder),
        orders=lambda: _orders(spark, folder, statuses),
        order_items=lambda: _order_items(spark, folder),
        reservations=lambda: _reservations(spark, folder),
        restaurants=lambda: _restaurants(spark, folder),
    )
