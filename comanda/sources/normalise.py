"""Bring differently named and typed source tables to one shape.

A column is taken if the source has it, under any of its known names, else it
is a typed NULL. Text that does not parse becomes NULL, not an error.
"""

from __future__ import annotations

from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.constants import DEFAULT_CATEGORY, DEFAULT_ZONE, UNKNOWN_STATUS
from comanda.schemas import MONEY
from comanda.sources.tables import Tables


class Wanted(NamedTuple):
    """A column of the shape: its names in sources, the first its own; rows need ``required``."""

    names: tuple[str, ...]
    kind: str | T.DataType = "string"
    default: object = None
    required: bool = False


# Fixed values -- the columns of each table, their names in sources, their defaults.
CONTRACTS: dict[str, tuple[Wanted, ...]] = {
    "users": (
        Wanted(("user_id", "id", "_id"), required=True),
        Wanted(("name",)),
        Wanted(("zone", "city"), default=DEFAULT_ZONE),
        Wanted(("latitude",), "double"),
        Wanted(("longitude",), "double"),
        Wanted(("referred_by",)),
    ),
    "products": (
        Wanted(("product_id", "id", "_id"), required=True),
        Wanted(("name",)),
        Wanted(("category",), default=DEFAULT_CATEGORY),
        Wanted(("price",), MONEY, 0),
    ),
    "orders": (
        Wanted(("order_id", "id", "_id"), required=True),
        Wanted(("user_id",)),
        Wanted(("restaurant_id",)),
        Wanted(("created_at",), "timestamp"),
        Wanted(("status",), default=UNKNOWN_STATUS),
        Wanted(("delivery_latitude", "latitude"), "double"),
        Wanted(("delivery_longitude", "longitude"), "double"),
        Wanted(("zone",), default=DEFAULT_ZONE),
    ),
    "order_items": (
        Wanted(("order_id",), required=True),
        Wanted(("product_id", "id"), required=True),
        Wanted(("quantity",), "int", 1),
        Wanted(("unit_price", "price"), MONEY, 0),
    ),
    "reservations": (
        Wanted(("reservation_id", "id", "_id"), required=True),
        Wanted(("user_id",)),
        Wanted(("restaurant_id",)),
        Wanted(("reservation_time", "date", "created_at"), "timestamp"),
        Wanted(("status",), default=UNKNOWN_STATUS),
        Wanted(("party_size",), "int", 1),
    ),
}


def shaped(raw: DataFrame, contract: tuple[Wanted, ...]) -> DataFrame:
    """The contract's columns of any source, and the rows that have the required ones."""
    columns = []
    for want in contract:
        found = [F.col(name).try_cast(want.kind) for name in want.names if name in raw.columns]
        columns.append(F.coalesce(*found, F.lit(want.default).cast(want.kind)).alias(want.names[0]))
    present = [F.col(want.names[0]).isNotNull() for want in contract if want.required]
    return raw.select(*columns).where(reduce(lambda a, b: a & b, present))


normalise_users = partial(shaped, contract=CONTRACTS["users"])
normalise_products = partial(shaped, contract=CONTRACTS["products"])
normalise_orders = partial(shaped, contract=CONTRACTS["orders"])
normalise_order_items = partial(shaped, contract=CONTRACTS["order_items"])
normalise_reservations = partial(shaped, contract=CONTRACTS["reservations"])


def normalise(raw: Tables) -> Tables:
    """All tables that have a contract, each shaped when first asked for."""

    def later(name: str, contract: tuple[Wanted, ...]):
        return lambda: shaped(getattr(raw, name), contract)

    return Tables(**{name: later(name, contract) for name, contract in CONTRACTS.items()})
