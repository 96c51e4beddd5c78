"""Bloom filters as arrays of longs, built and asked by SQL functions alone."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import stored


@dataclass(frozen=True)
class Bloom:
    """``words`` is a frame of one row with an array of longs."""

    words: DataFrame
    bits: int
    hashes: int
    seed: int


def _places(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    """The bits of a key; hashes differ by seed."""
    return [F.pmod(F.xxhash64(F.lit(seed * 64 + i), key), F.lit(bits)) for i in range(hashes)]


def filter_bits(n: int, rate: float) -> int:
    """Bits of a filter of ``n`` keys that lets a share ``rate`` of others pass."""
    return 64 * max(1, math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 64))


def build(keys: DataFrame, n: int, rate: float, seed: int, most_bits: int | None = None) -> Bloom:
    """A filter of the ``n`` keys in column key. Capped at ``most_bits``, more others pass."""
    bits = min(filter_bits(n, rate), most_bits or 1 << 62)
    hashes = max(1, round(-math.log2(rate)))
    place = F.explode(F.array(*_places(F.col("key"), bits, hashes, seed)))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    words = keys.select(place.alias("place")).groupBy((F.col("place") / 64).cast("long").alias("word"))
    words = words.agg(F.bit_or(one).alias("bits"))
    # Words without a bit are absent from the groups; the whole row has them as 0.
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    filled = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    row = filled.agg(F.transform(in_order, lambda w: w.getField("bits")).alias("words"))
    return Bloom(stored(row, "bloom"), bits, hashes, seed)


def passes(key: Column, bloom: Bloom) -> Column:
    """Whether the filter has all bits of the key. The filter is a scalar subquery."""
    words = bloom.words.scalar()
    found = F.lit(True)
    for place in _places(key, bloom.bits, bloom.hashes, bloom.seed):
        word = F.get(words, (place / 64).cast("int"))
        found = found & (F.call_function("shiftrightunsigned", word, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return found
