"""Load the property graph from its exchange files into stored tables."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from comanda.operators.graph import EDGE_KEYS, NODE_KEYS, from_files
from comanda.session import prepare, remove_run_folders
from comanda.sinks.buckets import BUCKETS, BucketTable
from comanda.sinks.warehouse import REJECTED, Version, new_load, publish, quarantine
from comanda.sources.tables import read_graph_files_checked

GRAPH_DATABASE = "comanda_grafo"
GRAPH = "grafo"
# Tables that are written side by side.
_AT_ONCE = 7


def tables(database: str = GRAPH_DATABASE, buckets: int = BUCKETS) -> dict[str, BucketTable]:
    """The stored tables of the graph, by node label and edge type, with their keys."""
    keys = {f"node_{name}": key for name, key in NODE_KEYS.items()}
    keys |= {f"edge_{name}": key for name, key in EDGE_KEYS.items()}
    return {name: BucketTable(name, key, GRAPH, database, buckets) for name, key in keys.items()}


def load(
    spark: SparkSession, folder: str, database: str = GRAPH_DATABASE, buckets: int = BUCKETS
) -> dict[str, int]:
    """Upsert the nodes and edges of the files; returns the rows of each table.

    A node or edge that is there already, by its key, takes the files' values.
    Only buckets in which something is new or differs are written. All tables
    are shown together, by one write, once they are complete. Lines that can't
    be read go to the table of rejected ones, which each load adds to, and are
    counted under its name.
    """
    prepare(spark)
    files, rejected = read_graph_files_checked(spark, folder)
    nodes, edges = from_files(files)
    stored = tables(database, buckets)
    number = new_load(spark, database)

    def put(name: str) -> list[Version]:
        kind, label = name.split("_", 1)
        return stored[name].upsert(getattr(nodes if kind == "node" else edges, label), number)

    # The tables do not depend on each other.
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        versions = [v for written in pool.map(put, stored) for v in written]
    publish(spark, GRAPH, versions, number, database)
    for table in stored.values():
        table.drop_old(spark)
    refused = quarantine(rejected, number, database)
    return {name: sum(v.rows for v in versions if v.table == name) for name in stored} | {REJECTED: refused}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load the graph's exchange files")
    parser.add_argument("--graph", required=True, help="folder of the exchange CSVs")
    parser.add_argument("--database", default=GRAPH_DATABASE)
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="of each table; fixed by the first load")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("comanda graph").getOrCreate()
    print(load(spark, args.graph, args.database, args.buckets))
    remove_run_folders()


if __name__ == "__main__":
    main()
