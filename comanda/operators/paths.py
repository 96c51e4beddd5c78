"""Paths of bounded length through a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.constants import DEPOT_ID, MAX_PATH_HOPS, SAMPLE_PATH_HOPS

KM, MINUTES = "decimal(28,3)", "decimal(28,2)"


def _first_hop(edges: DataFrame, start: str) -> DataFrame:
    leg = edges.where(F.col("from_id") == start)
    return leg.select(
        F.col("to_id").alias("at"),
        F.array("from_id", "to_id").alias("nodes"),
        F.array("edge_id").alias("used"),
        F.lit(1).alias("hops"),
        "km",
        "minutes",
    )


def _next_hop(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """Extend each path by one edge it has not used."""
    leg = edges.select(
        "from_id", "to_id", "edge_id", F.col("km").alias("_km"), F.col("minutes").alias("_min")
    )
    step = leg.join(
        F.broadcast(paths),
        (F.col("at") == F.col("from_id")) & ~F.array_contains("used", F.col("edge_id")),
    )
    return step.select(
        F.col("to_id").alias("at"),
        F.concat("nodes", F.array("to_id")).alias("nodes"),
        F.concat("used", F.array("edge_id")).alias("used"),
        (F.col("hops") + 1).alias("hops"),
        (F.col("km") + F.col("_km")).cast(KM).alias("km"),
        (F.col("minutes") + F.col("_min")).cast(MINUTES).alias("minutes"),
    )


def _best_paths(
    edges: DataFrame, start: str, max_hops: int, k: int, order: list[Column]
) -> DataFrame:
    """The k first of all paths from ``start`` of 1 to ``max_hops`` edges.

    ``order`` must put every path behind the shorter path it extends. So a path
    that k others come before never leads into the result, and neither does one
    behind the k-th: only paths before the k-th are extended, hop by hop, and
    where none of the last hop is left, what is found is proven. A hop is one
    scan of the edges that leave its ends; k rows come to the driver, the report.
    """
    spark = edges.sparkSession
    best = _first_hop(edges, start)
    schema, rows = best.schema, best.orderBy(*order).limit(k).collect()  # bounded: k
    for hop in range(1, max_hops):
        before = rows[: k - 1] if len(rows) == k else rows
        frontier = [r for r in before if r["hops"] == hop]
        if not frontier:
            break
        leaving = edges.where(F.col("from_id").isin({r["at"] for r in frontier}))
        further = _next_hop(spark.createDataFrame(frontier, schema), leaving)
        best = spark.createDataFrame(rows, schema).unionByName(further)
        rows = best.orderBy(*order).limit(k).collect()  # bounded: k
    return spark.createDataFrame(rows, schema).orderBy(*order)


def _legs(edges: DataFrame) -> DataFrame:
    """Route edges as (edge_id, from_id, to_id, km, minutes); no measure is 0.

    Measures are exact decimals at the places that legs are rounded to, so a
    path's length does not depend on the order of its sum. The k best can only
    be found hop by hop where no leg is negative: such a leg raises.
    """
    km = F.coalesce(F.col("distance_from_previous_km"), F.lit(0.0))
    checked = F.when(km < 0, F.raise_error(F.lit("a leg has a negative distance"))).otherwise(km)
    return edges.select(
        F.struct("courier_id", "stop_order", "from_location_id", "to_location_id").alias("edge_id"),
        F.col("from_location_id").alias("from_id"),
        F.col("to_location_id").alias("to_id"),
        checked.cast(KM).alias("km"),
        F.coalesce("estimated_minutes", F.lit(0.0)).cast(MINUTES).alias("minutes"),
    )


def _named(paths: DataFrame, locations: DataFrame) -> DataFrame:
    """Add the names of a path's nodes, in order. ``paths`` has k rows."""
    steps = paths.select("*", F.posexplode("nodes").alias("pos", "node"))
    names = locations.select(F.col("location_id").alias("node"), "name")
    listed = (
        names.join(F.broadcast(steps), "node")
        .groupBy("used", "at", "hops", "km", "minutes")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("steps"))
    )
    return listed.withColumn("ruta", F.transform("steps", lambda step: step["name"]))


def nearest_destinations(
    edges: DataFrame,
    locations: DataFrame,
    start: str = DEPOT_ID,
    max_hops: int = MAX_PATH_HOPS,
    k: int = 5,
) -> DataFrame:
    """The k shortest paths from ``start``, with their summed legs.

    Distances are never negative, so a path is at least as long as the paths
    it extends. Ties go to fewer hops, then to the smaller destination id.
    """
    order = [F.asc("km"), F.asc("hops"), F.asc("at"), F.asc("used")]
    best = _best_paths(_legs(edges), start, max_hops, k, order)
    return (
        _named(best, locations)
        .orderBy(*order)
        .select(
            F.element_at("ruta", -1).alias("destino"),
            "ruta",
            F.col("km").cast("double").alias("distancia_total_km"),
            F.col("minutes").cast("double").alias("tiempo_total_min"),
        )
    )


def sample_paths(
    edges: DataFrame,
    start: str = DEPOT_ID,
    max_hops: int = SAMPLE_PATH_HOPS,
    k: int = 20,
) -> DataFrame:
    """The k first paths from ``start``, fewest hops first."""
    order = [F.asc("hops"), F.asc("nodes"), F.asc("used")]
    best = _best_paths(_legs(edges), start, max_hops, k, order)
    return best.orderBy(*order).select("hops", F.concat_ws(" > ", "nodes").alias("path"))
