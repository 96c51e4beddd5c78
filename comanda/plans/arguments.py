"""Command-line arguments that name a source."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

from comanda.sources import sample
from comanda.sources.tables import Tables, collection_loader, jdbc_loader, load_source

# Reader options by environment variable, so that no password is on a command line.
JDBC_ENVIRONMENT = {"user": "COMANDA_JDBC_USER", "password": "COMANDA_JDBC_PASSWORD"}
MONGO_ENVIRONMENT = {"connection.uri": "COMANDA_MONGO_URI"}


def add_source(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--source", choices=["sample", "postgres", "mongo"], default="sample")
    parser.add_argument("--fallback", choices=["sample"], help="read this if the source fails")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-partitions", type=int, default=8)
    parser.add_argument(
        "--jdbc-range", action="append", default=[], metavar="TABLE=LOW:HIGH",
        help="the range of a table's numeric ids; read by it instead of by a hash",
    )
    parser.add_argument(
        "--jdbc-sample", type=float, metavar="PERCENT",
        help="split text ids into equally large ranges, by a sample of this share of each table",
    )
    parser.add_argument("--mongo-database")
    parser.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE", help="a reader option"
    )


def from_environment(names: Mapping[str, str]) -> dict[str, str]:
    return {option: os.environ[name] for option, name in names.items() if name in os.environ}


def read_source(spark: SparkSession, args: argparse.Namespace) -> Tables:
    options = dict(option.split("=", 1) for option in args.option)
    ranges = {}
    for given in args.jdbc_range:
        table, limits = given.split("=", 1)
        low, high = limits.split(":")
        ranges[table] = (int(low), int(high))
    jdbc = {"driver": "org.postgresql.Driver", **from_environment(JDBC_ENVIRONMENT), **options}
    mongo = {**from_environment(MONGO_ENVIRONMENT), **options}
    if args.mongo_database:
        mongo["database"] = args.mongo_database
    loaders = {
        "sample": sample.load,
        "postgres": jdbc_loader(args.jdbc_url, jdbc, args.jdbc_partitions, ranges, args.jdbc_sample),
        "mongo": collection_loader(mongo),
    }
    return load_source(spark, args.source, loaders, args.fallback)
