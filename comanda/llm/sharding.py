"""Contiguous shards of near-equal size, cut from global prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import n_bytes, running_totals, stored

SHARDS = 40
# Bytes that a document takes besides its text.
OVERHEAD = 16


def assign_shards(
    df: DataFrame, order: Sequence[str], size: str, n_shards: int = SHARDS
) -> DataFrame:
    """Add shard (0 to n_shards - 1) and slot (0, 1, ... in each shard).

    Rows in the order of ``order`` (nulls last) are cut at equal shares of the
    sum of ``size``; a row goes where its middle falls, so that a shard differs
    from its share by less than one row. Every shard is a contiguous range. The
    positions come from totals per range, never from one sorted partition; a
    single row larger than a share fills its shard alone and may leave empty
    ones beside it. All other columns are carried along, so pass only those
    that are needed. Rows equal in order and size may change places; sizes of
    null count as 0. No rows: no rows.
    """
    if not {"shard", "slot", "_size", "_before", "_row", "_part"}.isdisjoint(df.columns):
        raise ValueError("the columns shard, slot, _size, _before, _row and _part must be free")
    sized = df.withColumn("_size", F.coalesce(F.col(size), F.lit(0)).cast("long"))
    placed = stored(running_totals(sized, [], order, "_size"), "placed")
    whole = placed.agg(F.sum("_size")).first()[0] or 1
    # Where the row's middle falls, in n_shards equal parts of the whole.
    share = F.expr(f"(2 * _before + _size) * {n_shards}L div {2 * whole}L")
    cut = placed.withColumn("shard", F.least(share, F.lit(n_shards - 1)).cast("int"))
    # n_shards rows.
    starts = cut.groupBy("shard").agg(F.min("_row").alias("_first"))
    return cut.join(F.broadcast(starts), "shard").select(
        *df.columns, "shard", (F.col("_row") - F.col("_first")).cast("long").alias("slot")
    )


def shard_documents(documents: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Place documents by doc_id: doc_id, size, text_crc32, shard, slot.

    The size is the text's UTF-8 bytes (null: none) and 16 more; the checksum
    of a null text is that of no bytes, 0. Texts stay where they are.
    """
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = documents.select(
        "doc_id", (n_bytes(F.col("text")) + OVERHEAD).alias("size"), crc.alias("text_crc32")
    )
    return assign_shards(rows, ["doc_id", "text_crc32"], "size", n_shards)


def write_shards(documents: DataFrame, path: str, n_shards: int = SHARDS) -> None:
    """Write whole documents as folders shard=0, shard=1, ..., by doc_id."""
    sized = documents.withColumn("_bytes", n_bytes(F.col("text")) + OVERHEAD)
    placed = assign_shards(sized, ["doc_id"], "_bytes", n_shards).drop("_bytes")
    placed.repartitionByRange(n_shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
