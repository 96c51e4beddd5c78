"""Products bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.session import materialise

# The share of all lines whose pairs are counted first, for a bound on the rest.
FIRST_SHARE = 0.02


def co_purchases(order_items: DataFrame) -> DataFrame:
    """Number of orders that hold both products of each unordered pair.

    A product listed twice in an order counts once. Lines meet themselves on
    the order, one plan whatever an order's length: the join of a very long
    order is split over tasks, and its pairs are counted map-side. The number of
    pairs is the size of the answer.
    """
    return _pair_counts(order_items.select("order_id", "product_id").distinct())


def _pair_counts(lines: DataFrame) -> DataFrame:
    """The same of lines (order_id, product_id) of which none comes twice."""
    here = lines.withColumnRenamed("product_id", "product_a_id")
    there = lines.withColumnRenamed("product_id", "product_b_id")
    pairs = here.join(there, "order_id").where(F.col("product_a_id") < F.col("product_b_id"))
    return pairs.groupBy("product_a_id", "product_b_id").agg(
        F.count(F.lit(1)).alias("times_bought_together")
    )


def most_frequent_first(co_purchases: DataFrame) -> DataFrame:
    return co_purchases.orderBy(
        F.desc("times_bought_together"), "product_a_id", "product_b_id"
    )


def frequent_pairs(lines: DataFrame, k: int, first: float = FIRST_SHARE) -> DataFrame:
    """All pairs as frequent as the k-th most frequent one, with their counts.

    ``lines`` are distinct (order_id, product_id). A pair is in no more orders
    than either of its products. So the k-th count among the pairs of the most
    frequent products, which have a ``first`` share of all lines together, is a
    bound: products in fewer orders than that are left out before any other
    pair is formed. Where there are not k pairs among them, more products are
    taken first. The bound comes to the driver, a number.
    """
    times = F.col("times_bought_together")
    support = materialise(lines.groupBy("product_id").agg(F.count(F.lit(1)).alias("orders")), "support")
    # Products by falling support: as many as a share of the lines has room for.
    levels = support.groupBy("orders").agg(F.sum("orders").alias("lines"))
    falling = Window.orderBy(F.desc("orders"))
    # One row per number of orders that a product is in.
    reached = levels.select(
        "orders",
        F.sum("lines").over(falling).alias("so_far"),
        F.sum("lines").over(Window.partitionBy()).alias("all"),
    )

    def of_support(least: int) -> DataFrame:
        if least <= 1:
            return lines
        kept = support.where(F.col("orders") >= least).select("product_id")
        return lines.join(kept, "product_id", "left_semi")

    bound, share = 1, first
    while True:
        head = reached.where(F.col("so_far") >= F.col("all") * share).agg(F.max("orders")).first()[0]
        if head is None or head <= 1:
            break
        best = _pair_counts(of_support(head)).orderBy(times.desc()).limit(k)
        least, found = best.agg(F.min(times), F.count(F.lit(1))).first()
        if found == k:
            bound = least
            break
        share *= 4
    counts = _pair_counts(of_support(bound))
    at_least = counts.orderBy(times.desc()).limit(k).agg(F.min(times))
    return counts.where(times >= at_least.scalar())


def top_bought_together(order_items: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent pairs of known products, by name.

    Ties are cut by both names, then by both ids, which are not shown. Only
    pairs as frequent as the k-th one are named, and only those are formed whose
    products are frequent enough for it.
    """
    ids = products.select("product_id")
    known = order_items.join(ids, "product_id", "left_semi").select("order_id", "product_id").distinct()
    times = F.col("times_bought_together")
    frequent = frequent_pairs(materialise(known, "lines"), k)

    def named(side: str) -> DataFrame:
        return products.select(
            F.col("product_id").alias(f"product_{side}_id"),
            F.col("name").alias(f"name_{side}"),
        )

    return (
        frequent.join(named("a"), "product_a_id")
        .join(named("b"), "product_b_id")
        .orderBy(times.desc(), "name_a", "name_b", "product_a_id", "product_b_id")
        .limit(k)
        .select(
            F.col("name_a").alias("producto_1"),
            F.col("name_b").alias("producto_2"),
            times.alias("veces_comprados_juntos"),
        )
    )
