"""Mixing sources to target weights, cut at exact budgets of words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import WORD, running_totals, stored, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def shuffle_key(doc_id: Column, seed: str = SEED) -> Column:
    """The place of a document in its source's random order: an MD5 in hex."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: source, source_size, target, budget.

    Sources, by code point and null last, weigh ``weights`` in turn and share
    the whole size. A target above ``epochs`` times its source is cut to that,
    and the excess is shared by weight among the others until none is above.
    Each turn is one aggregate of which only two sums reach the driver.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(per_source, [], ["source"], "source_size")
    turn = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(turn, (F.col("_row") % len(weights) + 1).cast("int")).cast("long")
    ranked = stored(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    cap = F.col("source_size") * epochs
    whole, share = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, count = whole or 0, share or 1

    def exact(c: Column) -> Column:
        return c.cast("decimal(38,0)")

    while True:
        above = exact(F.lit(rest) * F.col("weight")) > exact(cap) * exact(F.lit(count))
        capped, free = ranked.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
        ).first()
        if (whole or 0) - capped == rest and free == count or not free:
            break
        rest, count = (whole or 0) - capped, free
    target = F.when(above, cap.cast("double")).otherwise(
        (F.lit(rest) * F.col("weight")).cast("double") / F.lit(count).cast("double")
    )
    return ranked.select(
        "source", "source_size", target.alias("target"), F.floor(target).cast("long").alias("budget")
    )


def mix(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    ``documents`` needs doc_id, text and source; other columns are left out.
    Returns one row per row: doc_id, source, size, source_size, target, taken,
    key. Documents of a source are put in a random order by hash and range-
    sorted; prefix sums of their sizes are distributed, so that a source may
    hold any share of the rows. A budget is met by whole epochs over its source
    and then by documents in order, the last of which is cut to its first words,
    so a source's taken words equal its target rounded down.

    Null text: size 0, nothing taken. Null source: a source of its own. Null or
    equal doc_ids: ordered by size; rows equal in everything may change places.
    No rows: no rows.
    """
    sizes = stored(
        documents.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), shuffle_key(F.col("doc_id"), seed).alias("key")
        ),
        "sizes",
    )
    targets = stored(source_targets(sizes, weights, epochs), "targets").withColumnRenamed("source", "_source")
    placed = running_totals(sizes, ["source"], ["key", "doc_id"], "size")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("budget") - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (passes * F.col("size") + part).cast("long").alias("taken"), "key",
    )


def source_cuts(mixed: DataFrame) -> DataFrame:
    """Per source: whole passes, and the document at which the last pass ends."""
    passes = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).cast("long")
    rows = mixed.withColumn("_passes", passes)
    least = rows.groupBy("source").agg(F.min("_passes").alias("passes"))
    least = least.withColumnRenamed("source", "_source")
    more = rows.join(least, F.col("source").eqNullSafe(F.col("_source")))
    extra = F.col("taken") - F.col("passes") * F.col("size")
    last = F.max(F.when(extra > 0, F.struct("key", "doc_id", "size", extra.alias("words"))))
    return more.groupBy("source").agg(F.first("passes").alias("passes"), last.alias("last"))


def take_mix(documents: DataFrame, mixed: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves: a row for each time a document is taken.

    The document at which a source's last pass ends comes with its first words
    only and n_chars to match. Texts are not shuffled: a source's cut is one row,
    and whether a document lies before it shows from the document alone.
    Documents without words carry none and come once per whole pass. Rows equal
    to the last taken one in doc_id and size are cut like it.
    """
    cuts = stored(source_cuts(mixed), "cuts").withColumnRenamed("source", "_source")
    key, size = shuffle_key(F.col("doc_id"), seed), word_count(F.col("text"))
    far = F.lit((1 << 63) - 1)
    at = F.struct(key, F.coalesce(F.col("doc_id"), far), size)
    end = F.struct(F.col("last.key"), F.coalesce(F.col("last.doc_id"), far), F.col("last.size"))
    joined = documents.join(cuts, F.col("source").eqNullSafe(F.col("_source")))
    full = F.coalesce(F.col("passes"), F.lit(0)) + F.when(F.col("last").isNotNull() & (at < end), 1).otherwise(0)
    is_last = F.col("last").isNotNull() & (at == end)
    whole = F.array_repeat(F.lit(-1).cast("long"), full.cast("int"))
    copies = F.concat(whole, F.when(is_last, F.array(F.col("last.words"))).otherwise(F.array().cast("array<long>")))
    rows = joined.withColumn("_words", F.explode(copies))
    words = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    kept = F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), "")
    cut = F.when((F.col("_words") >= 0) & (F.col("_words") < word_count(F.col("text"))), kept)
    out = rows.withColumn("_cut", cut)
    if "n_chars" in documents.columns:
        shorter = F.length("_cut").cast("long")
        out = out.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(shorter))
    return out.withColumn("text", F.coalesce("_cut", "text")).select(*documents.columns)
