"""Positions in a global order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.session import materialise

# monotonically_increasing_id() holds the partition above bit 33 and the
# row's place in the partition below it.
_PLACE_BITS = 33


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Add each row's position, from 0, in the order of ``order_by``.

    Rows are range-partitioned and sorted by the keys and written once, so
    that both steps below see the same ranges. A position is then the row's
    place in its partition plus the rows of the partitions before. Rows equal
    in ``order_by`` are ordered by their other columns.
    """
    keys = [*order_by, *[c for c in df.columns if c not in order_by]]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(ranged.withColumn("_id", F.monotonically_increasing_id()), "ordinal")
    part = F.shiftright("_id", _PLACE_BITS)
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition of the write: small enough to broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + place).alias(name))
    )


def with_group_ordinal(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str], name: str = "ordinal"
) -> DataFrame:
    """Add each row's position, from 0, within its group.

    The position in the order of group and keys, less the group's first one:
    no group is ever sorted by a single task. Group columns must not be NULL.
    """
    placed = with_ordinal(df, [*group, *order_by], "_at")
    starts = placed.groupBy(*group).agg(F.min("_at").alias("_start"))
    return placed.join(starts, list(group)).select(
        *df.columns, (F.col("_at") - F.col("_start")).alias(name)
    )
