"""Near-equal vectors by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import running_totals, stored
from comanda.llm.components import components

COSINE = 0.93
# Projections counted for each pair, and how many of them are sorted for windows.
PROJECTIONS, SORTED = 48, 4
# Half a window, in standard deviations of a projected difference at the threshold.
HALF_WINDOW = 2.0
# A pair at the threshold misses a count with at most this probability.
MISS = 1e-6
# Vectors of one block of a sorted projection; a task holds two blocks.
BLOCK = 2_048
# Projections after which pairs with too few collisions are let go.
LOOKS = (16, 32, 48)
SEED = 11


def directions(width: int) -> np.ndarray:
    """Random directions with standard normal components, (width, PROJECTIONS)."""
    return np.random.default_rng(SEED).standard_normal((width, PROJECTIONS))


def half_window(cosine: float) -> float:
    """Unit vectors at the threshold are sqrt(2 - 2 cosine) apart; so are projections, on average."""
    return HALF_WINDOW * math.sqrt(max(0.0, 2 - 2 * cosine))


def least_collisions(n: int, miss: float = MISS) -> int:
    """The largest count that a pair at the threshold reaches in n but with probability miss."""
    p = math.erf(HALF_WINDOW / math.sqrt(2))
    below, count = 0.0, 0
    while below + math.comb(n, count) * p**count * (1 - p) ** (n - count) <= miss:
        below += math.comb(n, count) * p**count * (1 - p) ** (n - count)
        count += 1
    return count


def is_usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    def bad(x: Column) -> Column:
        wide = x.cast("double")
        return wide.isNull() | F.isnan(wide) | (F.abs(wide) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def _units(vectors: pd.Series) -> np.ndarray:
    """Unit vectors in double precision, scaled first so that squares stay in range."""
    rows = np.array(vectors.tolist(), np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def _project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, rows in batch.groupby("width"):
            values = _units(rows["embedding"]) @ directions(int(rows["width"].iloc[0]))[:, :SORTED]
            for i in range(SORTED):
                yield pd.DataFrame(
                    {"label": rows["label"], "width": rows["width"], "turn": i, "value": values[:, i], "node": rows["node"]}
                )


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Enough of the links (a, b) to connect what they connect: each place with its least."""
    lowest = np.arange(max(a.max(initial=-1), b.max(initial=-1)) + 1)
    while len(a):
        before = lowest.copy()
        low = np.minimum(lowest[a], lowest[b])
        np.minimum.at(lowest, lowest[a], low)
        np.minimum.at(lowest, lowest[b], low)
        lowest = lowest[lowest]
        if (before == lowest).all() and (lowest[a] == lowest[b]).all():
            break
    return lowest


def _collide(cosine: float):
    window = half_window(cosine)
    least = [least_collisions(n) for n in LOOKS]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        turn = int(rows["turn"].iloc[0])
        low, high = int(rows["left"].iloc[0]), int(rows["right"].iloc[0])
        units = _units(rows["embedding"])
        spots = (units @ directions(units.shape[1])).astype(np.float32)
        nodes, block = rows["node"].to_numpy(), rows["block"].to_numpy()
        here, there = np.flatnonzero(block == low), np.flatnonzero(block == high)
        queries, partners = [], []
        # A strip of queries against the whole other block keeps the counts small.
        for at in range(0, len(here), 512):
            strip = here[at : at + 512]

            def near(j: int) -> np.ndarray:
                return np.abs(spots[strip, None, j] - spots[None, there, j]) <= window

            open_pair = near(turn)
            # What met in the window of an earlier turn is found there.
            for j in range(turn):
                open_pair &= ~near(j)
            if low == high:
                open_pair &= nodes[strip][:, None] < nodes[there][None, :]
            count = np.zeros(open_pair.shape, np.int8)
            for j in range(LOOKS[0]):
                count += near(j)
            q, c = np.nonzero(open_pair & (count >= least[0]))
            met = count[q, c].astype(np.int64)
            q, c = strip[q], there[c]
            for start, end, enough in zip(LOOKS, LOOKS[1:], least[1:]):
                met = met + (np.abs(spots[q, start:end] - spots[c, start:end]) <= window).sum(1)
                go_on = met >= enough
                q, c, met = q[go_on], c[go_on], met[go_on]
            linked = np.concatenate(
                [np.einsum("ij,ij->i", units[q[i : i + 65536]], units[c[i : i + 65536]]) >= cosine
                 for i in range(0, len(q), 65536)] or [np.empty(0, bool)]
            )
            queries.append(q[linked])
            partners.append(c[linked])
        q, c = np.concatenate(queries), np.concatenate(partners)
        copies = rows["copies"].to_numpy()
        around = np.bincount(q, weights=copies[c], minlength=len(rows)) + np.bincount(c, weights=copies[q], minlength=len(rows))
        met = np.flatnonzero(around)
        root = _forest(q, c)
        return pd.DataFrame({"a": nodes[met], "b": nodes[root[met]], "around": around[met].astype(np.int64)})

    return run


def similar(nodes: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """Links of nodes with one label whose cosine is at least ``cosine``: a, b, around.

    ``nodes`` has node (long), label, width, copies and embedding. Each of a few
    random projections is sorted within a label and cut into blocks of ``block``
    rows; two blocks meet in a task if a window around some value of one reaches
    the other. A task counts, for the pairs in each other's window, the
    projections of all that put both in one window, drops pairs below counts
    calibrated on the threshold, and confirms the others by cosine. So no task
    holds more than two blocks, whatever a label's share of the rows. A pair
    belongs to the first projection whose window it meets in, so to one task.

    A task returns a row for each node a with links there: ``around`` is how
    many vectors, copies counted, it links a with, and b is a node that those
    links reach. All (a, b) together connect what the links connect. A pair at
    the threshold is found with probability above 0.9999: 1 - 0.046**4 for the
    windows, less 3e-6 for the counts; closer pairs with more.
    """
    narrow = nodes.select("label", "width", "node", "embedding").mapInPandas(
        _project, f"label {dict(nodes.dtypes)['label']}, width int, turn int, value double, node long"
    )
    # The place in the sorted projection comes from distributed counts.
    ones = narrow.withColumn("one", F.lit(1).cast("long"))
    group = ["label", "width", "turn"]
    placed = running_totals(ones, group, ["value", "node"], "one")
    placed = stored(placed.withColumn("block", F.floor(F.col("_row") / block).cast("int")).drop("one", "_before", "_row"), "placed")
    spans = placed.groupBy(*group, "block").agg(F.min("value").alias("from"), F.max("value").alias("to"))
    left = spans.select(*group, F.col("block").alias("left"), F.col("to").alias("end"))
    right = spans.select(*group, F.col("block").alias("right"), F.col("from").alias("start"))
    meet = (F.col("left") <= F.col("right")) & (F.col("start") - F.col("end") <= half_window(cosine))
    tiles = stored(left.join(right, group).where(meet).select(*group, "left", "right"), "tiles")
    sides = tiles.withColumn("block", F.explode(F.array_distinct(F.array("left", "right"))))
    vectors = nodes.select("node", "embedding", "copies")
    dealt = placed.drop("value").join(sides, [*group, "block"]).join(vectors, "node")
    return dealt.groupBy(*group, "left", "right").applyInPandas(_collide(cosine), "a long, b long, around long")


def link_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """Links and components: vec_id, n_links, component_id, kept, one row per row.

    ``vectors`` has vec_id, embedding and label; other columns are left out.
    Vectors with equal, non-null labels and lengths are linked from a cosine of
    ``cosine`` in double precision. n_links counts the other vectors linked
    directly; component_id is the smallest vec_id reachable, its own included;
    kept tells whether that is its own.

    Equal vectors of a label are one node with a count, so copies are never
    expanded into pairs. Vectors that are null, zero, or hold null or non-finite
    components, and those without label, link with nothing. Rows of one vec_id
    are vectors of their own and may link. Null vec_ids count as larger than
    all others. No rows: no rows.
    """
    usable = is_usable(F.col("embedding")) & F.col("label").isNotNull()
    rows = stored(vectors.select("vec_id", "embedding", "label", usable.alias("usable")), "vectors")
    same = ["digest", "label", "embedding"]
    good = rows.where("usable").withColumn("digest", F.xxhash64("label", "embedding"))
    grouped = good.groupBy(*same).agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(
        grouped.withColumn("width", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "nodes"
    )
    found = stored(similar(nodes, cosine, block), "similar")
    linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("around").alias("around"))
    lows = components(found.select("a", "b"))
    marked = nodes.join(lows, "node", "left").withColumn("low", F.coalesce("low", "node"))
    ids = marked.groupBy("low").agg(F.min("least").alias("component_id"))
    per_node = marked.join(ids, "low").join(linked, "node", "left").select(
        *same, "component_id", (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).alias("n_links")
    )
    rated = good.join(per_node, same).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return rated.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
