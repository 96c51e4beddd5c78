"""The nightly load: check sources, load the star, publish catalogue changes."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators import star as star_operators
from comanda.operators.quality import (
    BUCKET,
    CATALOGUE,
    catalogue_changes,
    differing_buckets,
    digest_tree,
    require_rows,
)
from comanda.operators.star import Star
from comanda.plans.arguments import add_source, read_source
from comanda.schemas import DATABASE
from comanda.session import materialise, prepare, remove_run_folders
from comanda.sinks.buckets import BucketTable, bucketed
from comanda.sinks.files import publish_changes
from comanda.sinks.warehouse import (
    CATALOGUE_STATE,
    STAR,
    Version,
    create_tables,
    current_load,
    new_load,
    publish,
    read_load,
    require_complete,
    write_version,
)
from comanda.sources.tables import Tables

SNAPSHOT = "catalogo_publicado"
PRINT = "huellas_catalogo"
# Buckets of the catalogue; a change costs the comparison of one.
BUCKETS = 256


@dataclass(frozen=True)
class LoadReport:
    """Rows of each table, its rows without a key or measure, and the catalogue's publication."""

    rows: dict[str, int]
    published: str | None
    missing: dict[str, dict[str, int]]


def _write_all(tables: dict[str, DataFrame], load: int, database: str) -> list[Version]:
    """Write tables that do not depend on each other side by side."""
    with ThreadPoolExecutor(len(tables)) as pool:
        running = [pool.submit(write_version, df, name, load, database) for name, df in tables.items()]
        return [future.result() for future in running]


def write_dimensions(source: Tables, load: int, database: str) -> list[Version]:
    dims = {
        "dim_tiempo": star_operators.dim_tiempo(source.orders, source.reservations),
        "dim_usuario": star_operators.dim_usuario(source.users),
        "dim_restaurante": star_operators.dim_restaurante(source.restaurants),
        "dim_producto": star_operators.dim_producto(source.products),
    }
    return _write_all(dims, load, database)


def write_facts(spark: SparkSession, source: Tables, load: int, database: str) -> list[Version]:
    """Both facts against the dimensions of the same load."""
    dims = (name for name in Star.NAMES if name.startswith("dim_"))
    star = Star(**{name: partial(read_load, spark, name, load, database) for name in dims})
    facts = {
        "fact_items_pedido": star_operators.fact_items_pedido(
            source.orders, source.order_items, star
        ),
        "fact_reservaciones": star_operators.fact_reservaciones(source.reservations, star),
    }
    return _write_all(facts, load, database)


def load_versions(
    spark: SparkSession, source: Tables, database: str = DATABASE, limits: Mapping[str, float] | None = None
) -> list[Version]:
    """Declare the warehouse, write all six tables, then show them by one write.

    Each table comes back with how many rows miss a key or a measure, which the
    writes have counted. Where that is more than ``limits`` (shares, by column)
    allow, nothing is shown.
    """
    create_tables(spark, database)
    load = new_load(spark, database)
    versions = write_dimensions(source, load, database)
    versions += write_facts(spark, source, load, database)
    require_complete(versions, limits or {})
    publish(spark, STAR, versions, load, database)
    return versions


def load_star(spark: SparkSession, source: Tables, database: str = DATABASE) -> dict[str, int]:
    """The same without limits; the rows of each table."""
    return {version.table: version.rows for version in load_versions(spark, source, database)}


def publish_catalogue(
    spark: SparkSession, products: DataFrame, database: str, path: str, buckets: int = BUCKETS
) -> str | None:
    """Publish what changed in the catalogue since it was last published.

    The catalogue is read once and written down, by buckets of its ids: what is
    compared, published and remembered is that copy, whatever the source does
    meanwhile. Its digest tree is held against the one remembered, from the top
    down, and only buckets that differ are compared and stored anew. They are
    remembered only after the changes are out, so a failed publication is
    repeated by the next load. Returns the publication's folder, or None.
    """
    catalogue = bucketed(products.select(*CATALOGUE), "id", buckets)
    now = materialise(digest_tree(catalogue, buckets), "digests")
    snapshot = BucketTable(SNAPSHOT, ("id",), CATALOGUE_STATE, database, buckets)
    parts = snapshot.parts(spark)
    remembered = current_load(spark, CATALOGUE_STATE, database)
    tree = now.limit(0) if remembered is None else read_load(spark, PRINT, remembered, database)
    differing = differing_buckets(tree, now, buckets)
    if remembered is not None and not differing:
        return None
    after = catalogue.where(F.col(BUCKET).isin(differing)).drop(BUCKET)
    before = snapshot.read(spark, [parts[b] for b in differing if b in parts]) if parts else after.limit(0)
    folder = publish_changes(catalogue_changes(before, after), path)
    load = new_load(spark, database)
    versions = snapshot.replace(after, differing, load)
    versions.append(write_version(now, PRINT, load, database))
    publish(spark, CATALOGUE_STATE, versions, load, database)
    snapshot.drop_old(spark)
    return folder


def run(
    spark: SparkSession,
    source: Tables,
    changes_path: str,
    database: str = DATABASE,
    limits: Mapping[str, float] | None = None,
) -> LoadReport:
    """Run the load in order; any failing step stops it."""
    prepare(spark)
    require_rows({"orders": source.orders})
    versions = load_versions(spark, source, database, limits)
    published = publish_catalogue(spark, source.products, database, changes_path)
    missing = {v.table: {c: n for c, n in v.nulls.items() if n} for v in versions}
    return LoadReport({v.table: v.rows for v in versions}, published, {t: m for t, m in missing.items() if m})


def main(arguments: Sequence[str] | None = None) -> None:
    """Load the star from a command line, e.g. through ``spark-submit``."""
    parser = argparse.ArgumentParser(description="Load the star, publish catalogue changes")
    add_source(parser)
    parser.add_argument("--changes", required=True, help="folder of the catalogue publications")
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument(
        "--limit", action="append", default=[], metavar="COLUMN=SHARE",
        help="reject the load where more than this share of rows misses a column",
    )
    args = parser.parse_args(arguments)
    limits = {c: float(share) for c, share in (text.rsplit("=", 1) for text in args.limit)}
    spark = SparkSession.builder.appName("comanda load").getOrCreate()
    report = run(spark, read_source(spark, args), args.changes, args.database, limits)
    print(report)
    remove_run_folders()


if __name__ == "__main__":
    main()
