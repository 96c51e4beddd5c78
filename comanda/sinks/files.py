"""Write results and the graph as CSV folders, and changes as JSON."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from comanda.constants import DEPOT_LATITUDE, DEPOT_LONGITUDE
from comanda.operators.graph import delivery_locations, recommendations
from comanda.operators.routing import route_edges
from comanda.schemas import GRAPH_FILES
from comanda.sources.tables import Tables


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of headered CSV files; as many as the result has partitions.

    An empty text is written as such, apart from NULL.
    """
    df.write.mode("overwrite").options(header=True, emptyValue='""').csv(path)


def write_results(results: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in results.items():
        write_csv(df, f"{folder}/{name}")


def graph_tables(
    data: Tables,
    co_purchases: DataFrame,
    routes: DataFrame,
    depot: tuple[float, float] = (DEPOT_LATITUDE, DEPOT_LONGITUDE),
) -> dict[str, DataFrame]:
    """The nine exchange tables of the graph, with the columns of its files."""
    tables = {
        **{name: df for name, df in data.items() if name in GRAPH_FILES},
        "recommendations": recommendations(data.users),
        "co_purchases": co_purchases,
        "locations": delivery_locations(routes, depot),
        "route_assignments": routes,
        "route_edges": route_edges(routes),
    }

    def column(df: DataFrame, field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return value.alias(field.name)

    return {
        name: tables[name].select(*[column(tables[name], f) for f in kinds.fields])
        for name, kinds in GRAPH_FILES.items()
    }


def export_graph(
    data: Tables,
    co_purchases: DataFrame,
    routes: DataFrame,
    folder: str,
    depot: tuple[float, float] = (DEPOT_LATITUDE, DEPOT_LONGITUDE),
) -> None:
    write_results(graph_tables(data, co_purchases, routes, depot), folder)


def publish_changes(changes: DataFrame, path: str) -> str:
    """Leave the changed catalogue rows as JSON lines for whoever indexes them.

    Each publication has a folder of its own below ``path``, named by its time,
    so one that is not consumed yet stays. Returns that folder.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S.%f")
    folder = f"{path}/{stamp}"
    changes.write.json(folder)
    return folder
