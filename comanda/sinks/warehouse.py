"""Write warehouse tables, load by load, and show all tables of a load at once.

The rows of a table lie in one stored table, in a folder per load. A view shows
those of the load that the pointer names. The pointer is the table ``cargas``:
a publication appends one file to it, with a line per table of the load, so a
single write switches all tables of a group, and a load that fails leaves
everything as it was. The views of a group ask the same question of the pointer,
which a query answers once, so tables that are joined are of one load.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping
from types import MappingProxyType
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.schemas import DATABASE, PARTITION, WAREHOUSE

PARTITIONED = ("fact_items_pedido", "fact_reservaciones")
# By which keys the rows of a month lie together: a look-up by one skips what has none of it.
CLUSTERED = {
    "fact_items_pedido": ("usuario_key", "producto_key"),
    "fact_reservaciones": ("usuario_key",),
}
POINTER = "cargas"
LOAD = "carga"
REJECTED = "filas_rechazadas"
# Tables that are always loaded together.
STAR, CATALOGUE_STATE, ANALYSIS = "estrella", "catalogo", "analisis"
# Loads that stay: the one shown, and the one before for those who still read it.
KEPT_LOADS = 2


class Version(NamedTuple):
    """A table as one load wrote it; ``part`` names a part of it, where it has several.

    ``nulls`` has the columns of the contract's keys and measures with how many
    rows miss them, counted while writing.
    """

    table: str
    load: int
    rows: int
    part: str = ""
    nulls: Mapping[str, int] = MappingProxyType({})


class LoadRejected(RuntimeError):
    """What a load wrote misses more than it may; nothing of it is shown."""


def checked_columns(name: str) -> list[str]:
    """Keys and measures: what a row of a warehouse table should have."""
    schema = WAREHOUSE.get(name, T.StructType())
    measures = (T.DecimalType, T.IntegerType)
    fact = name in PARTITIONED
    return [
        f.name for f in schema
        if f.name.endswith("_key") or f.name.endswith("_id") or (fact and isinstance(f.dataType, measures))
    ]


def require_complete(versions: Iterable[Version], limits: Mapping[str, float]) -> None:
    """Raise where a column misses a larger share of its rows than ``limits`` allow.

    Limits are by ``table.column``, or by column for all tables. A column
    without one may miss any number.
    """
    over = []
    for v in versions:
        for column, count in v.nulls.items():
            limit = limits.get(f"{v.table}.{column}", limits.get(column))
            if limit is not None and count > limit * v.rows:
                over.append(f"{v.table}.{column}: {count} of {v.rows}")
    if over:
        raise LoadRejected("missing values: " + ", ".join(over))


def stored_name(name: str) -> str:
    return f"{name}__cargas"


def _comment(name: str, column: str) -> str:
    """What the warehouse contract says of a column."""
    if column == PARTITION:
        return "tiempo_key without day and hour"
    schema = WAREHOUSE.get(name)
    known = schema is not None and column in schema.fieldNames()
    return (schema[column].metadata or {}).get("comment", "") if known else ""


def table_ddl(
    name: str,
    schema: T.StructType,
    database: str = DATABASE,
    stored: str | None = None,
    folders: tuple[tuple[str, str], ...] = ((LOAD, "BIGINT"),),
) -> str:
    """The stored table of ``name``: its columns, and the folders its rows lie in."""
    inner = ((PARTITION, "INT"),) if name in PARTITIONED else ()
    fields = [(f.name, f.dataType.simpleString().upper()) for f in schema.fields if f.name != PARTITION]
    columns = []
    for field, kind in (*fields, *folders, *inner):
        comment = _comment(name, field)
        columns.append(f"`{field}` {kind} COMMENT '{comment}'" if comment else f"`{field}` {kind}")
    partition = ", ".join(f"`{c}`" for c, _ in (*folders, *inner))
    looked_up = ",".join(c for c in CLUSTERED.get(name, ()))
    options = "'compression' 'snappy'" + (f", 'orc.bloom.filter.columns' '{looked_up}'" if looked_up else "")
    return (
        f"CREATE TABLE IF NOT EXISTS {database}.{stored or stored_name(name)} ({', '.join(columns)}) "
        f"USING ORC OPTIONS ({options}) PARTITIONED BY ({partition})"
    )


def _current(group: str, database: str) -> str:
    return f"(SELECT max({LOAD}) FROM {database}.{POINTER} WHERE grupo = '{group}')"


def shown_rows(name: str, group: str, database: str) -> str:
    """The condition on a stored table for the rows of the load that is shown."""
    return f"{LOAD} = {_current(group, database)}"


def shown_parts(name: str, group: str, database: str) -> str:
    """The same for a table of parts, of which a load replaces some."""
    listed = (
        f"SELECT parte FROM {database}.{POINTER} WHERE grupo = '{group}' AND tabla = '{name}' "
        f"AND {LOAD} = {_current(group, database)}"
    )
    return f"parte IN ({listed})"


def declare_pointer(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{POINTER} "
        f"(tabla STRING, parte STRING, filas BIGINT, grupo STRING, {LOAD} BIGINT) "
        f"USING ORC PARTITIONED BY (grupo, {LOAD})"
    )


def declare(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    database: str = DATABASE,
    stored: str | None = None,
    folders: tuple[tuple[str, str], ...] = ((LOAD, "BIGINT"),),
) -> None:
    """Create the stored table unless it is there; its columns must be those of ``schema``."""
    stored = stored or stored_name(name)
    spark.sql(table_ddl(name, schema, database, stored, folders))
    there = dict(spark.table(f"{database}.{stored}").dtypes)
    wanted = {f.name: f.dataType.simpleString() for f in schema} | {c: there[c] for c, _ in folders}
    wanted |= {PARTITION: "int"} if name in PARTITIONED else {}
    if there != wanted:
        changed = sorted(set(there.items()) ^ set(wanted.items()))
        raise ValueError(f"{database}.{name} has other columns than this load: {changed}")


def declare_view(
    spark: SparkSession, name: str, group: str, database: str = DATABASE, stored: str | None = None, shown=shown_rows
) -> None:
    """Have the table's view read what the pointer shows; one that does so stays."""
    stored, table = stored or stored_name(name), f"{database}.{name}"
    condition = shown(name, group, database)
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "VIEW":
            text = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
            if f".{stored} " in text and f"'{group}'" in text:
                return
        else:
            spark.sql(f"DROP TABLE {table}")
    columns = [c for c in spark.table(f"{database}.{stored}").columns if c not in (LOAD, "parte")]
    listed = ", ".join(f"`{c}` COMMENT '{_comment(name, c)}'" for c in columns)
    taken = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {table} ({listed}) AS SELECT {taken} FROM {database}.{stored} WHERE {condition}")


def create_tables(spark: SparkSession, database: str = DATABASE) -> None:
    """Declare the warehouse by its contract, and the views over it; a load does so first."""
    declare_pointer(spark, database)
    for name, schema in WAREHOUSE.items():
        declare(spark, name, schema, database)
        declare_view(spark, name, STAR, database)


def current_load(spark: SparkSession, group: str, database: str = DATABASE) -> int | None:
    """The load that a group's views show; None before the first one."""
    if not spark.catalog.tableExists(f"{database}.{POINTER}"):
        return None
    return spark.sql(f"SELECT {_current(group, database)}").first()[0]


def new_load(spark: SparkSession, database: str = DATABASE) -> int:
    """A number above those of all loads before; from the clock, so that it tells when."""
    declare_pointer(spark, database)
    last = spark.table(f"{database}.{POINTER}").agg(F.max(LOAD)).first()[0] or 0
    return max(last + 1, time.time_ns() // 1_000_000)


def read_load(spark: SparkSession, name: str, load: int, database: str = DATABASE) -> DataFrame:
    """A table as a certain load wrote it, shown or not yet shown; no other folder is read."""
    return spark.table(f"{database}.{stored_name(name)}").where(F.col(LOAD) == load).drop(LOAD)


def write_version(df: DataFrame, name: str, load: int, database: str = DATABASE) -> Version:
    """Write a table's rows of a load; they and what they miss are counted while writing.

    Files are evened out first; a month too large for one task is split, and
    small ones share a task. Inside a month, rows lie by user and then product:
    stripes and row groups have narrow ranges of users and Bloom filters of both
    keys, so a look-up reads few of them.
    """
    spark = df.sparkSession
    declare(spark, name, WAREHOUSE.get(name, df.schema), database)
    seen = Observation(f"write {name} {load}")
    checked = [c for c in checked_columns(name) if c in df.columns]
    missing = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked]
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *missing)
    if name in PARTITIONED:
        df = df.withColumn(PARTITION, F.expr("cast(tiempo_key div 10000 as int)"))
        df = df.hint("rebalance", F.col(PARTITION)).sortWithinPartitions(PARTITION, *CLUSTERED[name])
    elif name == "dim_tiempo":
        df = df.sortWithinPartitions("tiempo_key")
    append_load(df, f"{database}.{stored_name(name)}", load)
    nulls = {c: observed(seen, f"null_{c}") for c in checked}
    return Version(name, load, observed(seen, "rows"), nulls=nulls)


def quarantine(rejected: DataFrame, load: int, database: str = DATABASE) -> int:
    """Keep the lines (source, file, line) that a load could not read, by its number; how many they are."""
    spark, table = rejected.sparkSession, f"{database}.{REJECTED}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (source STRING, file STRING, line STRING, {LOAD} BIGINT) "
        f"USING ORC PARTITIONED BY ({LOAD})"
    )
    seen = Observation(f"rejected {load}")
    append(rejected.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(LOAD, F.lit(load).cast("long")), table)
    return observed(seen, "rows")


def observed(seen: Observation, name: str) -> int:
    """A count taken while writing; 0 where the plan turned out empty and was cut before it was observed."""
    try:
        return seen.get[name]
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        return 0


def append(df: DataFrame, table: str) -> None:
    """Add rows to a stored table, by name."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def append_load(df: DataFrame, table: str, load: int) -> None:
    """Add the rows of a load; its folder is named by the statement, so their order is kept."""
    spark, view = df.sparkSession, f"load_{uuid.uuid4().hex}"
    columns = [c for c in spark.table(table).columns if c != LOAD]
    df.select(*columns).createOrReplaceTempView(view)
    inner = f", {PARTITION}" if PARTITION in columns else ""
    try:
        spark.sql(f"INSERT INTO {table} PARTITION ({LOAD} = {load}{inner}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def publish(
    spark: SparkSession, group: str, versions: Iterable[Version], load: int, database: str = DATABASE
) -> None:
    """Show a load: one write, after which all tables of the group are those of ``versions``.

    Views are declared before. The load before stays readable; older ones, and
    what failed loads left, go afterwards. One load of a group runs at a time.
    """
    versions = list(versions)
    whole = [v.table for v in versions if not v.part]
    for name in whole:
        declare_view(spark, name, group, database)
    lines = [(v.table, v.part, v.rows, group, load) for v in versions]
    kinds = f"tabla string, parte string, filas long, grupo string, {LOAD} long"
    append(spark.createDataFrame(lines, kinds).coalesce(1), f"{database}.{POINTER}")  # bounded: a line per table and part

    kept = kept_loads(spark, group, database)
    for name in whole:
        for old in folders(spark, f"{database}.{stored_name(name)}"):
            if int(old) not in kept and int(old) < load:
                drop_folder(spark, f"{database}.{stored_name(name)}", {LOAD: old})
    for old in folders(spark, f"{database}.{POINTER}", f"grupo={group}"):
        if int(old) not in kept:
            drop_folder(spark, f"{database}.{POINTER}", {"grupo": group, LOAD: old})


def kept_loads(spark: SparkSession, group: str, database: str) -> list[int]:
    """The shown load and those before it that stay."""
    loads = spark.table(f"{database}.{POINTER}").where(F.col("grupo") == group).select(LOAD).distinct()
    return [r[0] for r in loads.orderBy(F.desc(LOAD)).limit(KEPT_LOADS).collect()]  # bounded: KEPT_LOADS


def _path(spark: SparkSession, table: str, inner: str = ""):
    """A stored table's folder, and its file system."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()  # bounded: one row
    path = spark._jvm.org.apache.hadoop.fs.Path(rows[0].data_type + ("/" + inner if inner else ""))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, table: str, inner: str = "") -> list[str]:
    """The values of the folders right below a stored table's, or below one of these."""
    path, files = _path(spark, table, inner)
    found = files.listStatus(path) if files.exists(path) else []
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if "=" in n)


def drop_folder(spark: SparkSession, table: str, values: Mapping[str, str]) -> None:
    """Drop a folder with all below it, in the catalogue too where that keeps track of folders."""
    spec = ", ".join(f"{c} = '{v}'" for c, v in values.items())
    try:
        for row in spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").collect():  # bounded: months of a load
            inner = ", ".join("{} = '{}'".format(*part.split("=", 1)) for part in row[0].split("/"))
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({inner})")
    except AnalysisException:
        # A catalogue that finds folders by looking has nothing to forget.
        pass
    path, files = _path(spark, table, "/".join(f"{c}={v}" for c, v in values.items()))
    files.delete(path, True)
    spark.catalog.refreshTable(table)


def write_tables(tables: Mapping[str, DataFrame], database: str, group: str) -> dict[str, int]:
    """Replace all tables of a group and return their numbers of rows."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    load = new_load(spark, database)
    versions = [write_version(df, name, load, database) for name, df in tables.items()]
    publish(spark, group, versions, load, database)
    return {v.table: v.rows for v in versions}
