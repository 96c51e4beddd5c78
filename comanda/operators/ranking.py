"""Ranks within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rank_within(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """SQL ``RANK() OVER (PARTITION BY group ORDER BY value DESC)``.

    A row's rank is one more than the number of rows in its group with a
    greater value. Rows are therefore counted per (group, value) first, and
    only those counts are sorted: a group with very many rows is never brought
    to one task. NULL groups match each other, as in a window. Counts and rows
    ask for the same columns of ``df``, so that an aggregate in it is computed
    once and its shuffle read twice.
    """
    rest = F.struct(*[c for c in df.columns if c not in (*group, value)])
    counts = df.groupBy(*group, value).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.hash(rest)).alias("_seen")
    )
    above = (
        Window.partitionBy(*group)
        .orderBy(F.desc(value))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = counts.select(
        *[F.col(c).alias(f"_{c}") for c in (*group, value)],
        (F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1).alias(name),
        "_seen",
    )
    same = [df[c].eqNullSafe(ranks[f"_{c}"]) for c in (*group, value)]
    # Always true; it keeps the columns of both sides alike.
    same.append(F.hash(rest) <= ranks["_seen"])
    return df.join(ranks, same).select(*df.columns, name)
