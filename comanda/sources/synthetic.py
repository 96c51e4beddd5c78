"""Generate transactions for existing users, restaurants and products.

Every draw is a hash of the row number and a seed, so the same call gives the
same rows however they are partitioned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.constants import (
    SEED_DAYS_BACK,
    SEED_MAX_ITEMS,
    SEED_MAX_LEAD_HOURS,
    SEED_MAX_PARTY,
    SEED_MAX_QUANTITY,
    SEED_PICKUP_SHARE,
    SEED_REFERRED_SHARE,
    SEED_STATUS_WEIGHTS,
    SEED_STATUSES,
)
from comanda.operators.ordinal import with_group_ordinal, with_ordinal
from comanda.schemas import MONEY, MONEY_SUM
from comanda.sources.tables import Tables


class _Draws:
    """Random-looking columns, told apart by a label."""

    def __init__(self, seed: int):
        self.seed = seed

    def below(self, limit, label: str, *of: str | Column) -> Column:
        """An integer from 0 to ``limit`` - 1."""
        limit = limit if isinstance(limit, Column) else F.lit(limit).cast("bigint")
        return F.pmod(F.xxhash64(F.lit(label), F.lit(self.seed), *of), limit)

    def share(self, label: str, *of: str) -> Column:
        """A number from 0 up to, but not including, 1."""
        return self.below(1 << 30, label, *of) / F.lit(float(1 << 30))

    def weighted(self, names: Sequence[str], weights: Sequence[float], label: str, *of: str):
        point, chosen, upto = self.share(label, *of), None, 0.0
        for name, weight in list(zip(names, weights))[:-1]:
            upto += weight
            hit = point < F.lit(upto)
            chosen = F.when(hit, name) if chosen is None else chosen.when(hit, name)
        return chosen.otherwise(names[-1])


def _numbered(df: DataFrame, column: str, number: str) -> tuple[DataFrame, int]:
    """The values of ``column`` numbered from 0, and how many there are."""
    numbered = with_ordinal(df.select(column).distinct(), [column], number)
    return numbered, numbered.count()


def _past(now: dt.datetime, days: int, draws: _Draws, label: str) -> Column:
    minutes = draws.below(days * 24 * 60 + 1, label, "n").cast("int")
    return F.lit(now).cast("timestamp") - F.make_dt_interval(mins=minutes)


def _distinct_picks(draws: _Draws, count: Column, size: Column) -> Column:
    """``count`` different positions below ``size``.

    Each new position is drawn from those still free: it skips, in ascending
    order, the ones already taken.
    """

    def skip(taken: Column, drawn: Column) -> Column:
        return F.aggregate(
            F.array_sort(taken), drawn, lambda at, used: at + F.when(used <= at, 1).otherwise(0)
        )

    def pick(taken: Column, turn: Column) -> Column:
        drawn = draws.below(size - turn, "pick", F.col("n"), turn)
        return F.concat(taken, F.array(skip(taken, drawn)))

    turns = F.sequence(F.lit(0).cast("bigint"), count - 1)
    return F.aggregate(turns, F.array().cast("array<bigint>"), pick)


def generate(
    spark: SparkSession,
    users: DataFrame,
    restaurants: DataFrame,
    products: DataFrame,
    n_orders: int = 300,
    n_reservations: int = 150,
    seed: int = 42,
    now: dt.datetime = dt.datetime(2026, 1, 1),
    roles: Sequence[str] | None = None,
) -> Tables:
    """Orders with items, reservations and referrals for the given members.

    ``roles`` limits who may order; only available products are ordered, from
    the menu of the order's own restaurant. An order drawn for a restaurant
    without a menu is left out.
    """
    draws = _Draws(seed)
    buyers = users.where(F.col("role").isin(*roles)) if roles else users
    buyer_ids, n_buyers = _numbered(buyers.select(F.col("id").alias("user_id")), "user_id", "u")
    places, n_places = _numbered(
        restaurants.select(F.col("id").alias("restaurant_id")), "restaurant_id", "r"
    )
    if not n_buyers or not n_places:
        raise ValueError("there are no users or no restaurants to draw from")

    def drawn(n: int, kind: str) -> DataFrame:
        rows = spark.range(n).select(
            F.col("id").alias("n"),
            draws.below(n_buyers, f"{kind} user", "id").alias("u"),
            draws.below(n_places, f"{kind} restaurant", "id").alias("r"),
        )
        return rows.join(buyer_ids, "u").join(places, "r").drop("u", "r")

    menu = with_group_ordinal(
        products.where(F.col("available")).select(
            F.col("restaurant_id").cast("string").alias("restaurant_id"),
            F.col("id").alias("product_id"),
            F.col("price").cast(MONEY).alias("price"),
        ),
        ["restaurant_id"],
        ["product_id"],
        "pick",
    )
    sizes = menu.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("size"))
    wanted = draws.below(SEED_MAX_ITEMS, "items", "n") + 1
    headers = drawn(n_orders, "order").join(sizes, "restaurant_id").select(
        "*",
        F.least(wanted, F.col("size")).alias("count"),
        F.concat(F.lit("order-"), F.col("n")).alias("id"),
    )
    picked = headers.select(
        "n", "id", "restaurant_id",
        F.posexplode(_distinct_picks(draws, F.col("count"), F.col("size"))).alias("line", "pick"),
    )
    lines = picked.join(menu, ["restaurant_id", "pick"]).select(
        F.concat_ws("-", "id", "line").alias("id"),
        F.col("id").alias("order_id"),
        "product_id",
        (draws.below(SEED_MAX_QUANTITY, "quantity", "n", "line") + 1).cast("int").alias("quantity"),
        "price",
        # The order total is drawn with quantities of its own.
        (draws.below(SEED_MAX_QUANTITY, "total", "n", "line") + 1).alias("_counted"),
    )
    totals = lines.groupBy(F.col("order_id").alias("id")).agg(
        F.sum(F.col("price") * F.col("_counted")).cast(MONEY_SUM).alias("total")
    )
    orders = headers.join(totals, "id").select(
        "id",
        "user_id",
        "restaurant_id",
        "total",
        draws.weighted(SEED_STATUSES, SEED_STATUS_WEIGHTS, "order status", "n").alias("status"),
        (draws.share("pickup", "n") < SEED_PICKUP_SHARE).alias("pickup"),
        _past(now, SEED_DAYS_BACK, draws, "order time").alias("created_at"),
    )

    lead = (draws.below(SEED_MAX_LEAD_HOURS, "lead", "n") + 1).cast("int")
    reservations = (
        drawn(n_reservations, "reservation")
        .withColumn("date", _past(now, SEED_DAYS_BACK, draws, "reservation time"))
        .select(
            F.concat(F.lit("reservation-"), F.col("n")).alias("id"),
            "restaurant_id",
            "user_id",
            "date",
            (draws.below(SEED_MAX_PARTY, "party", "n") + 1).cast("int").alias("party_size"),
            draws.weighted(
                SEED_STATUSES, SEED_STATUS_WEIGHTS, "reservation status", "n"
            ).alias("status"),
            (F.col("date") - F.make_dt_interval(hours=lead)).alias("created_at"),
        )
    )

    return Tables(
        users=_refer(users, buyers, draws),
        products=products,
        orders=orders,
        order_items=lines.drop("_counted"),
        reservations=reservations,
        restaurants=restaurants,
    )


def _refer(users: DataFrame, buyers: DataFrame, draws: _Draws) -> DataFrame:
    """A third of the buyers refer; half of the others were referred by one."""
    shuffled = buyers.select(
        draws.below(1 << 62, "referrer", "id").alias("draw"), F.col("id").alias("buyer")
    )
    ranked = with_ordinal(shuffled, ["draw", "buyer"], "rank").drop("draw")
    total = ranked.count()
    n_referrers = max(1, total // 3) if total >= 2 else 0
    users = users.drop("referred_by")
    if not n_referrers:
        return users.withColumn("referred_by", F.lit(None).cast("string"))
    referrers = ranked.where(F.col("rank") < n_referrers).select(
        F.col("rank").alias("by"), F.col("buyer").alias("referred_by")
    )
    referred = ranked.where(
        (F.col("rank") >= n_referrers) & (draws.share("referred", "buyer") < SEED_REFERRED_SHARE)
    ).select(F.col("buyer").alias("id"), draws.below(n_referrers, "by", "buyer").alias("by"))
    return users.join(referred.join(referrers, "by").drop("by"), "id", "left")
