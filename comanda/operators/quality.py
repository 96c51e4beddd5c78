"""Checks on sources and tables, and differences between two catalogues."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.functions.keys import one_per_key
from comanda.operators.star import Star

# Where a row's bucket stands, and buckets that have one fingerprint together.
BUCKET, FAN = "_bucket", 32
CATALOGUE = ("id", "name", "category", "price", "available")


class SourceNotReady(RuntimeError):
    """A source cannot be read or has no rows."""


def require_rows(tables: Mapping[str, DataFrame]) -> None:
    """Raise unless every table can be read and has a row; reads one row each."""
    for name, df in tables.items():
        try:
            empty = df.isEmpty()
        except Exception as error:
            raise SourceNotReady(f"{name} cannot be read") from error
        if empty:
            raise SourceNotReady(f"{name} has no rows")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def dangling_keys(star: Star) -> DataFrame:
    """Per fact and dimension, the rows whose member is unknown; one scan each."""

    def report(name: str, fact: DataFrame) -> DataFrame:
        keys = [c for c in fact.columns if c.endswith("_key")]
        totals = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in keys])
        long = totals.unpivot([], keys, "llave", "sin_miembro")
        return long.select(F.lit(name).alias("tabla"), "llave", "sin_miembro")

    return report("fact_items_pedido", star.fact_items_pedido).unionByName(
        report("fact_reservaciones", star.fact_reservaciones)
    )


def _digest_sums(columns: Sequence[str]) -> list[Column]:
    """Count and sums that change when any row does, whatever the order of rows.

    A row's MD5 is over its values as text, each with its length in front, so
    that neither NULL nor a shifted border goes unseen. Its first 60 bits are
    summed, and its next 60 apart.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    parts = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
    digest = F.md5(F.concat(*parts).cast("binary"))

    def total(start: int) -> Column:
        part = F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(part), F.lit(0)).cast("string")

    return [F.count(F.lit(1)).alias("filas"), total(1).alias("suma"), total(16).alias("suma_2")]


def fingerprint(df: DataFrame, columns: Sequence[str] = CATALOGUE) -> DataFrame:
    """One row that changes when any row does, whatever their order."""
    return df.agg(*_digest_sums(columns))


def digest_tree(df: DataFrame, buckets: int, columns: Sequence[str] = CATALOGUE) -> DataFrame:
    """Fingerprints of each bucket of rows, of each bucket of buckets, and so on to one root.

    ``df`` has its rows' buckets in ``_bucket``. A level's sums are those of the
    level below added up, so the rows are read once. Level 0 are the buckets of
    rows; an empty bucket has no line.
    """
    level = df.groupBy(F.col(BUCKET).alias("cubo")).agg(*_digest_sums(columns))
    tree, number = level.withColumn("nivel", F.lit(0)), 0
    while number < tree_levels(buckets):
        number += 1
        whole = [F.sum("filas").alias("filas")] + [
            F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("suma", "suma_2")
        ]
        level = level.groupBy(F.floor(F.col("cubo") / FAN).cast("int").alias("cubo")).agg(*whole)
        tree = tree.unionByName(level.withColumn("nivel", F.lit(number)))
    return tree.select("nivel", "cubo", "filas", "suma", "suma_2")


def tree_levels(buckets: int) -> int:
    """Levels above the buckets, up to the one root."""
    levels = 0
    while buckets > 1:
        buckets, levels = -(-buckets // FAN), levels + 1
    return levels


def differing_buckets(old: DataFrame, new: DataFrame, buckets: int) -> list[int]:
    """Buckets whose fingerprints differ: from the root down, below what differs only.

    At most as many numbers as there are buckets come to the driver.
    """
    below: list[int] | None = None
    for number in range(tree_levels(buckets), -1, -1):

        def lines(tree: DataFrame) -> DataFrame:
            found = tree.where(F.col("nivel") == number).drop("nivel")
            if below is not None:
                found = found.where(F.floor(F.col("cubo") / FAN).isin(below))
            return found

        before, after = lines(old), lines(new)
        changed = before.exceptAll(after).unionByName(after.exceptAll(before)).select("cubo").distinct()
        below = sorted(r.cubo for r in changed.collect())  # bounded: numbers of buckets
        if not below:
            break
    return below or []


def catalogue_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows added, removed or changed, with both states of a changed row."""

    def state(df: DataFrame, suffix: str) -> DataFrame:
        kept = one_per_key(df.select(*CATALOGUE), "id")
        kept = kept.withColumn("id", F.col("id").cast("string"))
        return kept.select(*[F.col(c).alias(f"{c}{suffix}") for c in CATALOGUE])

    before, after = state(old, "_old"), state(new, "_new")
    values = [c for c in CATALOGUE if c != "id"]
    same = reduce(
        lambda a, b: a & b, [F.col(f"{c}_old").eqNullSafe(F.col(f"{c}_new")) for c in values]
    )
    change = (
        F.when(F.col("id_old").isNull(), "added")
        .when(F.col("id_new").isNull(), "removed")
        .when(~same, "changed")
    )
    return (
        before.join(after, F.col("id_old") == F.col("id_new"), "full")
        .select(
            F.coalesce("id_old", "id_new").alias("id"),
            change.alias("change"),
            *[f"{c}_{when}" for c in values for when in ("old", "new")],
        )
        .where(F.col("change").isNotNull())
    )
