"""Surrogate keys and one-row-per-key reduction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def surrogate_key(natural: Column, strategy: str = "xxhash64") -> Column:
    """Hash of a natural key as bigint; NULL stays NULL.

    ``crc32`` keeps 32-bit keys for warehouses that already hold them, but
    collides from tens of thousands of members on: see ``distinct_keys``.
    """
    text = natural.cast("string")
    if strategy == "xxhash64":
        return F.when(text.isNotNull(), F.xxhash64(text))
    if strategy == "crc32":
        return F.crc32(text).cast("bigint")
    raise ValueError(f"unknown key strategy: {strategy}")


def distinct_keys(members: DataFrame, key: str, natural: str) -> DataFrame:
    """Give members whose hash key is another's a key of their own.

    The one with the smallest natural id keeps the hash; the n-th after it gets
    that with n put into the upper half, where no ``crc32`` has any bits. A fact
    finds its member's key through the natural id.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(natural)) - 1
    own = F.shiftleft(place.cast("bigint"), 32).bitwiseXOR(F.col(key))
    return members.withColumn("_place", place).withColumn(
        key, F.when(F.col("_place") == 0, F.col(key)).otherwise(own)
    ).drop("_place")


def one_per_key(
    df: DataFrame, key: str | Sequence[str], newest: Sequence[str] = ()
) -> DataFrame:
    """Keep one row per key, always the same one.

    The row with the greatest ``newest`` columns wins, then the greatest row.
    Rows are reduced map-side, so many copies of a key cost no shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    ranked = F.struct(*newest, *[name for name in rest if name not in newest])
    kept = df.groupBy(*keys).agg(F.max(ranked).alias("_kept"))
    return kept.select(
        *[F.col(c) if c in keys else F.col("_kept")[c].alias(c) for c in df.columns]
    )
