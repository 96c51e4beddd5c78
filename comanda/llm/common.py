"""Texts as words and bytes, and prefix sums, shared by the operators here."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comanda.session import materialise as stored

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# The struct in which a caller's other columns go through an operator.
TRAVELLING = "_travelling_columns"

# Bytes of an Arrow batch that carries whole texts; a longer text is a batch alone.
TEXT_BATCH = 4 << 20


def text_batches(spark: SparkSession, size: int = TEXT_BATCH) -> None:
    """Bound the bytes of Arrow batches, so that long texts stay within memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null. Works in place, without a list of words."""
    marks = F.regexp_replace(F.regexp_replace(text, WORD, "x"), SPACE, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def n_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def with_own_columns(
    docs: DataFrame, own: Sequence[str], operator: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Apply ``operator`` to the ``own`` columns, and give the others back as they were.

    The others travel in one struct, whose fields are numbered, so no name of
    the caller's can meet one of the operator's. Rows that ``operator`` takes
    out or repeats, it does with what travels. The columns come back in their
    order; those of the operator's that the caller doesn't have are left out.
    """
    others = [c for c in docs.columns if c not in own]
    if not others:
        return operator(docs).select(*docs.columns)
    packed = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    found = operator(docs.select(*[c for c in docs.columns if c in own], packed.alias(TRAVELLING)))
    places = {c: F.col(TRAVELLING)[f"c{i}"].alias(c) for i, c in enumerate(others)}
    return found.select(*[places.get(c, F.col(f"`{c}`")) for c in docs.columns])


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str
) -> DataFrame:
    """Add ``_before`` and ``_row``: sum of ``value`` and count of rows before, per group.

    Rows are range-partitioned by group and order (nulls last) and written with
    the number of their range. Inside a range a window runs; ranges before it
    are added from per-range totals, of which there is one per range and group.
    A group of any size is thus spread over many tasks. Rows equal in all of
    ``group``, ``order`` and ``value`` may change places.
    """
    keys = [F.col(c).asc_nulls_last() for c in [*group, *order, value]]
    ranged = stored(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    here = [F.col(c) for c in group]
    totals = ranged.groupBy(*here, "_part").agg(
        F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per range and group.
    earlier = Window.partitionBy(*here).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_row0"),
    )
    inside = Window.partitionBy("_part", *here).orderBy(*keys)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns(
        {
            "_sum1": F.coalesce(F.sum(value).over(before), F.lit(0)),
            "_row1": F.row_number().over(inside) - 1,
        }
    )
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return local.join(stored(offsets, "offsets"), same).select(
        *df.columns,
        (F.col("_sum0") + F.col("_sum1")).cast("long").alias("_before"),
        (F.col("_row0") + F.col("_row1")).cast("long").alias("_row"),
    )
