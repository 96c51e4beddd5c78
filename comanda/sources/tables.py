"""The bundle of operational tables and the readers that can fill it."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import pairwise
from typing import NamedTuple

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.schemas import GRAPH_FILES
from comanda.session import materialise

log = logging.getLogger(__name__)


class LazyTables:
    """Named tables; one given as a function is built when first asked for."""

    NAMES: tuple[str, ...] = ()

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        unknown = set(tables) - set(self.NAMES)
        if unknown:
            raise TypeError(f"unknown tables: {sorted(unknown)}")
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in self.NAMES if name in self._tables]


TABLE_NAMES = ("users", "products", "orders", "order_items", "reservations")


class Tables(LazyTables):
    """Operational tables, raw or normalised. ``restaurants`` only feeds the star.

    ``order_lines`` is derived: orders joined with items, by whoever wrote it
    down for several analyses.
    """

    NAMES = (*TABLE_NAMES, "restaurants", "order_lines")


# SQL that hashes a key to an int on the database side.
KEY_HASH = {
    "postgresql": "hashtext({column}::text)",
    "spark": "hash({column})",
}


def jdbc_predicates(column: str, partitions: int, hash_sql: str) -> list[str]:
    """WHERE clauses that split a table by key hash: every row in exactly one."""
    value = hash_sql.format(column=column)
    clauses = [
        f"(({value} % {partitions}) + {partitions}) % {partitions} = {part}"
        for part in range(partitions)
    ]
    clauses[0] = f"({clauses[0]}) OR {column} IS NULL"
    return clauses


# SQL for the least key of each of a number of equally large tiles of a sample.
# The database sorts, as its order of text is what the clauses are judged by.
_TILES = (
    "SELECT min(k) AS k FROM (SELECT {{column}} AS k, ntile({{tiles}}) OVER (ORDER BY {{column}}) AS tile "
    "FROM {{table}} {sample} WHERE {{column}} IS NOT NULL) tiles GROUP BY tile ORDER BY 1"
)
TILES = {
    "postgresql": _TILES.format(sample="TABLESAMPLE SYSTEM ({percent})"),
    "spark": _TILES.format(sample="TABLESAMPLE ({percent} PERCENT)"),
}


def _text_literal(value: str, dialect: str) -> str:
    if dialect == "spark":
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return "'" + value.replace("'", "''") + "'"


def tiles_query(table: str, column: str, partitions: int, percent: float, dialect: str) -> str:
    """The query for the places where a table is cut into equally large parts, by a sample of it."""
    return TILES[dialect].format(table=table, column=column, tiles=partitions, percent=percent)


def range_predicates(column: str, tiles: Sequence[str], dialect: str = "postgresql") -> list[str]:
    """WHERE clauses between the least keys of tiles: every row in exactly one, nulls in the first.

    ``tiles`` are in the database's order. Ranges are half-open, so equal keys
    stay together, and a key that fills several tiles has one clause.
    """
    cuts = [_text_literal(t, dialect) for t in dict.fromkeys(tiles[1:]) if t != tiles[0]]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in pairwise(cuts)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partitions: int = 1,
    key: str = "id",
    dialect: str = "postgresql",
    key_range: tuple[int, int] | None = None,
    sample_percent: float | None = None,
) -> DataFrame:
    """Read a database table in parallel.

    A numeric key with a known range is read as ranges, so that an index can
    serve them. So is a text key, cut where a sample of ``sample_percent`` of
    the table's blocks says that the parts are equally large; as many keys as
    there are partitions come back from it. Any other key is split by hash,
    for which each task has the database look at every row.
    """
    properties = dict(properties)
    if partitions <= 1:
        return spark.read.jdbc(url=url, table=table, properties=properties)
    if key_range is None and sample_percent is not None:
        query = tiles_query(table, key, partitions, sample_percent, dialect)
        tiles = [str(r[0]) for r in read_jdbc_query(spark, url, query, properties).collect()]  # bounded: a key per partition
        clauses = range_predicates(key, tiles, dialect)
        return spark.read.jdbc(url=url, table=table, predicates=clauses, properties=properties)
    if key_range is not None:
        low, high = key_range
        return spark.read.jdbc(
            url=url, table=table, column=key, lowerBound=low, upperBound=high,
            numPartitions=partitions, properties=properties,
        )
    clauses = jdbc_predicates(key, partitions, KEY_HASH[dialect])
    return spark.read.jdbc(url=url, table=table, predicates=clauses, properties=properties)


def read_jdbc_query(
    spark: SparkSession, url: str, query: str, properties: Mapping[str, str]
) -> DataFrame:
    """Let the database run ``query`` and read its result."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**properties).load()


def read_collection(
    spark: SparkSession,
    collection: str,
    options: Mapping[str, str],
    fmt: str = "mongodb",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read a document collection through whichever connector ``fmt`` names."""
    reader = spark.read.format(fmt).options(**{**options, "collection": collection})
    return (reader.schema(schema) if schema else reader).load()


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read a collection exported as JSON lines."""
    return spark.read.json(path, schema=schema) if schema else spark.read.json(path)


# Where a reader leaves the text of a line that it can't read by the schema.
CORRUPT = "_corrupt_record"


class Checked(NamedTuple):
    """Rows that could be read, and the lines that could not: (source, file, line)."""

    rows: DataFrame
    rejected: DataFrame


def _checked(reader: DataFrameReader, fmt: str, path: str, schema: T.StructType, source: str) -> Checked:
    """Read once, written down, so that both parts are of one reading."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).schema(wide)
    read = materialise(reader.format(fmt).load(path).withColumn("_file", F.input_file_name()), "read")
    bad = F.col(CORRUPT).isNotNull()
    rejected = read.where(bad).select(
        F.lit(source).alias("source"), F.col("_file").alias("file"), F.col(CORRUPT).alias("line")
    )
    return Checked(read.where(~bad).select(*schema.fieldNames()), rejected)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, source: str) -> Checked:
    """``read_csv``, with lines apart that have a malformed value or another number of fields."""
    options = {"header": True, "enforceSchema": False, "emptyValue": "", "nullValue": "\\N"}
    return _checked(spark.read.options(**options), "csv", path, schema, source)


def read_documents_checked(spark: SparkSession, path: str, schema: T.StructType, source: str) -> Checked:
    """JSON lines by a schema, with lines apart that are no JSON or have a value of another type."""
    return _checked(spark.read, "json", path, schema, source)


def read_graph_files_checked(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The exchange files of the graph by name, and all lines that were rejected."""
    read = {
        name: read_csv_checked(spark, f"{folder}/{name}", schema, name) for name, schema in GRAPH_FILES.items()
    }
    rejected = reduce(DataFrame.unionByName, [found.rejected for found in read.values()])
    return {name: found.rows for name, found in read.items()}, rejected


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with declared types; columns are matched by position."""
    reader = spark.read.options(header=True, enforceSchema=False, emptyValue="", nullValue="\\N")
    return reader.csv(path, schema=schema)


def read_graph_files(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The exchange files of the graph, typed, by name."""
    return {
        name: read_csv(spark, f"{folder}/{name}", schema) for name, schema in GRAPH_FILES.items()
    }


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{name}" if database else name)


def read_folder(spark: SparkSession, folder: str, fmt: str = "parquet") -> Tables:
    """One sub-folder or file set per table, named like the table."""
    load = {name: spark.read.format(fmt).load(f"{folder}/{name}") for name in TABLE_NAMES}
    return Tables(**load)


Loader = Callable[[SparkSession], Tables]


def load_source(
    spark: SparkSession,
    source: str,
    loaders: Mapping[str, Loader],
    fallback: str | None = None,
) -> Tables:
    """Fill the bundle from the named source.

    A failing source raises. Only when ``fallback`` names another source is
    that one read instead, and the log says so.
    """
    if source not in loaders:
        raise ValueError(f"unknown source {source!r}; known: {sorted(loaders)}")
    try:
        return loaders[source](spark)
    except Exception:
        if fallback is None or fallback == source:
            raise
        log.warning("source %s failed, reading %s instead", source, fallback, exc_info=True)
        return loaders[fallback](spark)


def jdbc_loader(
    url: str,
    properties: Mapping[str, str],
    partitions: int = 8,
    key_ranges: Mapping[str, tuple[int, int]] | None = None,
    sample_percent: float | None = None,
) -> Loader:
    """Read all tables of a database.

    ``key_ranges`` has those of numeric ids, by table; with ``sample_percent``
    the ids of the other tables are split by ranges of text.
    """

    def load(spark: SparkSession) -> Tables:
        ranges = key_ranges or {}
        read = {
            name: read_jdbc_table(
                spark, url, name, properties, partitions, key_range=ranges.get(name),
                sample_percent=sample_percent,
            )
            for name in (*TABLE_NAMES, "restaurants")
        }
        return Tables(**read)

    return load


def collection_loader(options: Mapping[str, str], fmt: str = "mongodb") -> Loader:
    def load(spark: SparkSession) -> Tables:
        return Tables(**{n: read_collection(spark, n, options, fmt) for n in TABLE_NAMES})

    return load
