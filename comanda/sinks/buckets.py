"""Keyed tables in buckets, of which a load rewrites only those it changes.

A row's bucket follows from its key. A load writes a new part for each bucket
that it changes and lists it with the parts of the others, which stay as they
are, in the pointer. So a small change costs a few buckets, and readers see all
tables of a load at once (``warehouse``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from comanda.operators.graph import upsert
from comanda.operators.quality import BUCKET
from comanda.session import materialise
from comanda.sinks import warehouse
from comanda.sinks.warehouse import LOAD, POINTER, Version, drop_folder, folders

BUCKETS = 64
PART = "parte"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key: the same for equal keys, whatever else is in a row."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys]
    return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows written down once, in a folder per bucket of their key, with the bucket's number."""
    named = df.withColumn(BUCKET, bucket_of([key], buckets)).hint("rebalance", F.col(BUCKET))
    return materialise(named, "bucketed", (BUCKET,))


def part_name(bucket: Column, load: int) -> Column:
    return F.concat(F.lpad(bucket.cast("string"), 6, "0"), F.lit(f"-{load}"))


@dataclass(frozen=True)
class BucketTable:
    """A keyed table of a group; ``buckets`` is fixed once it is stored."""

    name: str
    keys: tuple[str, ...]
    group: str
    database: str
    buckets: int = BUCKETS

    @property
    def stored(self) -> str:
        return f"{self.name}__cubos{self.buckets}"

    def parts(self, spark: SparkSession, load: int | None = None) -> dict[int, Version]:
        """The part of each bucket in a load, the shown one unless told otherwise; a few numbers a bucket."""
        load = warehouse.current_load(spark, self.group, self.database) if load is None else load
        if load is None:
            return {}
        lines = spark.table(f"{self.database}.{POINTER}").where(
            (F.col("grupo") == self.group) & (F.col("tabla") == self.name) & (F.col(LOAD) == load)
        )
        found = lines.where(F.col(PART) != "").collect()  # bounded: a line per bucket
        return {int(r.parte.split("-")[0]): Version(self.name, load, r.filas, r.parte) for r in found}

    def read(self, spark: SparkSession, parts: Iterable[Version]) -> DataFrame:
        """The rows of some parts; no other folder is read."""
        table = spark.table(f"{self.database}.{self.stored}")
        return table.where(F.col(PART).isin([p.part for p in parts])).drop(PART)

    def replace(self, rows: DataFrame, touched: Iterable[int], load: int) -> list[Version]:
        """Write the ``touched`` buckets anew, all of whose rows ``rows`` has; the parts of the load.

        Untouched buckets keep their parts. Nothing is shown before the load is
        published.
        """
        spark, touched = rows.sparkSession, sorted(touched)
        warehouse.declare_pointer(spark, self.database)
        warehouse.declare(spark, self.name, rows.schema, self.database, self.stored, ((PART, "STRING"),))
        kept = {b: v._replace(load=load) for b, v in self.parts(spark).items() if b not in set(touched)}
        if touched:
            seen = Observation(f"write {self.name} {load}")
            bucket = bucket_of(self.keys, self.buckets)
            counts = [F.count_if(bucket == b).alias(f"b{b}") for b in touched]
            named = rows.observe(seen, *counts).withColumn(PART, part_name(bucket, load))
            warehouse.append(named.hint("rebalance", F.col(PART)), f"{self.database}.{self.stored}")
            for b in touched:
                count = warehouse.observed(seen, f"b{b}")
                if count:
                    kept[b] = Version(self.name, load, count, f"{b:06d}-{load}")
        warehouse.declare_view(
            spark, self.name, self.group, self.database, self.stored, warehouse.shown_parts
        )
        return [kept[b] for b in sorted(kept)]

    def upsert(self, new: DataFrame, load: int) -> list[Version]:
        """Put ``new`` in, one row a key, over rows of equal key.

        Rows that are there already with the same values change nothing: a
        bucket is rewritten only where a row is new or differs.
        """
        spark = new.sparkSession
        new = materialise(new.withColumn("_bucket", bucket_of(self.keys, self.buckets)), self.name)
        parts = self.parts(spark)
        columns = [c for c in new.columns if c != "_bucket"]
        if not parts:
            return self.replace(new.select(*columns), _buckets(new), load)
        met = [parts[b] for b in _buckets(new) if b in parts]
        old = self.read(spark, met).select(*columns)
        digest = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
        same = F.col("n._digest") == F.col("o._digest")
        for c in columns:
            same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
        fresh = new.withColumn("_digest", digest).alias("n").join(
            old.withColumn("_digest", digest).alias("o"), same, "left_anti"
        )
        delta = materialise(fresh.select(*columns, "_bucket"), self.name)
        touched = _buckets(delta)
        old = self.read(spark, [parts[b] for b in touched if b in parts]).select(*columns)
        return self.replace(upsert(old, delta.select(*columns), *self.keys), touched, load)

    def drop_old(self, spark: SparkSession) -> None:
        """Drop the parts that no kept load lists."""
        kept = set()
        for load in warehouse.kept_loads(spark, self.group, self.database):
            kept |= {v.part for v in self.parts(spark, load).values()}
        shown = warehouse.current_load(spark, self.group, self.database)
        for part in folders(spark, f"{self.database}.{self.stored}"):
            if part not in kept and int(part.split("-")[1]) <= shown:
                drop_folder(spark, f"{self.database}.{self.stored}", {PART: part})


def _buckets(df: DataFrame) -> list[int]:
    """The buckets that rows lie in: at most as many numbers as there are buckets."""
    return sorted(r[0] for r in df.select("_bucket").distinct().collect())  # bounded: numbers of buckets
