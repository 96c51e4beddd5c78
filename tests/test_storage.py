"""Stored star, CSV exchange files and the nightly load."""

import json
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from comanda.constants import SMALL_FLEET
from comanda.operators import graph, olap, routing, star
from comanda.operators.basket import co_purchases
from comanda.plans import analysis, arguments, graph_load, nightly
from comanda.schemas import GRAPH_FILES, WAREHOUSE
from comanda.session import materialise
from comanda.sinks import files, warehouse
from comanda.sources.tables import Tables, read_graph_files

DB = "pruebas_dw"


@pytest.fixture(scope="module")
def loaded(spark, operational_sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("changes"))
    return nightly.run(spark, operational_sample, path, DB), path


def test_load_reports_rows(loaded):
    report, _ = loaded
    assert report.rows == {
        "dim_tiempo": 12, "dim_usuario": 5, "dim_restaurante": 3, "dim_producto": 6,
        "fact_items_pedido": 18, "fact_reservaciones": 5,
    }
    assert report.published


def test_stored_star_answers_like_the_composed_one(spark, loaded, operational_sample):
    stored = star.read_star(spark, DB)
    composed = star.build_star(operational_sample, resolve=False)
    for name, view in olap.VIEWS.items():
        args = () if view is olap.order_status_mix else (("completed",),)
        assert sorted(rows(view(stored, *args)), key=repr) == sorted(
            rows(view(composed, *args)), key=repr
        ), name
    olap.register_views(stored)
    assert spark.sql("select count(*) from olap_estado_pedidos").first()[0] == 4


def test_stored_tables_keep_their_contract(spark, loaded):
    for name, schema in WAREHOUSE.items():
        found = spark.table(f"{DB}.{name}")
        kept = [f for f in found.schema if f.name != warehouse.PARTITION]
        assert [(f.name, f.dataType) for f in kept] == [(f.name, f.dataType) for f in schema]
        comments = {f.name: f.metadata.get("comment", "") for f in found.schema}
        assert all(comments[f.name] == f.metadata.get("comment", "") for f in schema)
        assert spark.catalog.getTable(f"{DB}.{name}").tableType == "VIEW"
        stored = f"{DB}.{warehouse.stored_name(name)}"
        detail = {r[0]: r[1] for r in spark.sql(f"describe formatted {stored}").collect()}
        assert detail["Provider"].lower() == "orc"


def test_month_filter_reads_one_month(spark, loaded):
    found = spark.table(f"{DB}.fact_items_pedido").where(F.col(warehouse.PARTITION) == 202605)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: [^\n]*isnotnull\(anio_mes", plan)
    assert found.count() == 6


def test_month_filter_on_a_view_reads_one_month(spark, loaded):
    olap.register_views(star.read_star(spark, DB))
    for name in ("olap_ingresos_por_mes_categoria", "olap_tendencias_consumo", "olap_estado_pedidos",
                 "olap_actividad_usuarios_por_restaurante"):
        found = spark.sql(f"select * from {name} where anio = 2026 and mes = 5")
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = re.findall(r"PartitionFilters: \[([^\]]*)", plan)
        assert filters and any("anio_mes" in f for f in filters), name


def test_second_load_changes_nothing(spark, loaded, operational_sample, tmp_path):
    before = sorted(rows(spark.table(f"{DB}.fact_items_pedido")))
    report = nightly.run(spark, operational_sample, str(tmp_path / "c"), DB)
    assert not report.published
    assert sorted(rows(spark.table(f"{DB}.fact_items_pedido"))) == before


def test_only_changes_are_published(spark, loaded, operational_sample, tmp_path):
    dearer = operational_sample.products.withColumn(
        "price", F.when(F.col("id") == "p6", F.lit(9)).otherwise(F.col("price")).cast("decimal(18,2)")
    )
    path = str(tmp_path / "changes")
    folder = nightly.publish_catalogue(spark, dearer, DB, path)
    lines = [json.loads(r[0]) for r in spark.read.text(folder).collect()]
    assert [(c["id"], c["change"], c["price_new"]) for c in lines] == [("p6", "changed", 9)]
    # The next publication leaves this one alone.
    again = nightly.publish_catalogue(spark, operational_sample.products, DB, path)
    assert again != folder and spark.read.text(folder).count() == 1
    assert [json.loads(r[0])["price_old"] for r in spark.read.text(again).collect()] == [9]


def test_a_change_while_publishing_is_not_lost(spark, operational_sample, tmp_path, monkeypatch):
    """The source moves on between publication and memory: the next load tells."""
    path, folder = str(tmp_path / "source"), str(tmp_path / "changes")

    def put(price):
        row = [("p1", "Pan", "pan", price, True)]
        kinds = "id string, name string, category string, price double, available boolean"
        spark.createDataFrame(row, kinds).write.mode("overwrite").parquet(path)
        spark.catalog.refreshByPath(path)

    def load():
        return nightly.publish_catalogue(spark, spark.read.parquet(path), "mudable_dw", folder)

    put(1.0)
    assert load()
    put(2.0)
    with monkeypatch.context() as patch:
        def publish(changes, target):
            left = files.publish_changes(changes, target)
            put(3.0)
            return left

        patch.setattr(nightly, "publish_changes", publish)
        second = load()
    third = load()
    prices = [json.loads(spark.read.text(f).first()[0])["price_new"] for f in (second, third)]
    assert prices == [2.0, 3.0]
    assert load() is None


def test_failed_publication_is_repeated(spark, loaded, operational_sample, tmp_path, monkeypatch):
    gone = operational_sample.products.where("id <> 'p1'")
    with monkeypatch.context() as patch:
        def fail(*_):
            raise OSError("disk full")

        patch.setattr(nightly, "publish_changes", fail)
        with pytest.raises(OSError):
            nightly.publish_catalogue(spark, gone, DB, str(tmp_path / "x"))
    assert nightly.publish_catalogue(spark, gone, DB, str(tmp_path / "y"))


def test_empty_source_stops_the_load(spark, operational_sample, tmp_path):
    tables = dict(operational_sample.items())
    tables["orders"] = tables["orders"].limit(0)
    with pytest.raises(Exception, match="no rows"):
        nightly.run(spark, Tables(**tables), str(tmp_path), "vacio_dw")


def test_readers_keep_a_whole_table_through_loads(spark, loaded, operational_sample):
    held = spark.table(f"{DB}.fact_items_pedido")
    before = sorted(rows(held))
    nightly.load_star(spark, operational_sample, DB)
    assert sorted(rows(held)) == before
    assert len(warehouse.folders(spark, f"{DB}.fact_items_pedido__cargas")) == 2
    nightly.load_star(spark, operational_sample, DB)
    assert len(warehouse.folders(spark, f"{DB}.fact_items_pedido__cargas")) == 2
    assert spark.table(f"{DB}.{warehouse.POINTER}").where("grupo = 'estrella'").select("carga").distinct().count() == 2


def test_declared_tables(spark):
    warehouse.create_tables(spark, "declarado_dw")
    found = {t.name for t in spark.catalog.listTables("declarado_dw") if not t.isTemporary}
    stored = {warehouse.stored_name(name) for name in WAREHOUSE}
    assert found == set(WAREHOUSE) | stored | {warehouse.POINTER}
    assert all(spark.table(f"declarado_dw.{name}").isEmpty() for name in WAREHOUSE)
    warehouse.create_tables(spark, "declarado_dw")


def test_graph_files_come_back(spark, sample_data, tmp_path):
    awkward = sample_data.users.unionByName(
        spark.createDataFrame(
            [("u9", 'Eva "la, jefa"', "", None, None, None)], sample_data.users.schema
        )
    )
    data = Tables(**{**dict(sample_data.items()), "users": awkward})
    routes = materialise(routing.route_assignments(data.orders, SMALL_FLEET), "routes")
    pairs = co_purchases(data.order_items)
    files.export_graph(data, pairs, routes, str(tmp_path))
    back = read_graph_files(spark, str(tmp_path))
    tables = files.graph_tables(data, pairs, routes)
    for name in GRAPH_FILES:
        assert sorted(rows(back[name]), key=repr) == sorted(rows(tables[name]), key=repr), name


def test_graph_is_loaded_from_its_files(spark, sample_data, tmp_path):
    routes = materialise(routing.route_assignments(sample_data.orders, SMALL_FLEET), "routes")
    pairs = co_purchases(sample_data.order_items)
    files.export_graph(sample_data, pairs, routes, str(tmp_path))
    counts = graph_load.load(spark, str(tmp_path), "grafo_dw")
    assert counts["node_users"] == 5 and counts["edge_route_to"] == 7 and counts["edge_contains"] == 18
    edges = graph.build_edges(sample_data, routes)
    for name in graph.EDGE_KEYS:
        wanted = getattr(edges, name)
        assert sorted(rows(spark.table(f"grafo_dw.edge_{name}").select(*wanted.columns)), key=repr) == sorted(
            rows(wanted), key=repr), name
    before = {t: sorted(rows(spark.table(f"grafo_dw.{t}")), key=repr) for t in counts}
    assert graph_load.load(spark, str(tmp_path), "grafo_dw") == counts
    assert before == {t: sorted(rows(spark.table(f"grafo_dw.{t}")), key=repr) for t in counts}


def test_file_edges_need_both_ends(spark, sample_data):
    routes = materialise(routing.route_assignments(sample_data.orders, SMALL_FLEET), "routes")
    tables = files.graph_tables(sample_data, co_purchases(sample_data.order_items), routes)
    tables["locations"] = tables["locations"].where("location_id <> 'loc-o1'")
    tables["products"] = tables["products"].where("product_id <> 'p1'")
    _, edges = graph.from_files(tables)
    assert edges.delivers_to.count() == 6
    assert {r["from_location_id"] for r in edges.route_to.collect()}.isdisjoint({"loc-o1"})
    assert edges.route_to.count() == 5 and edges.bought_together.count() == 7


def test_graph_nodes_and_edges(spark, sample_data):
    routes = materialise(routing.route_assignments(sample_data.orders, SMALL_FLEET), "routes")
    nodes, edges = graph.build_nodes(sample_data, routes), graph.build_edges(sample_data, routes)
    counts = {n: getattr(nodes, n).count() for n in graph.NODE_KEYS}
    assert counts == {
        "users": 5, "products": 6, "orders": 8, "couriers": 2, "locations": 8, "stops": 7
    }
    sizes = {n: getattr(edges, n).count() for n in edges.__dataclass_fields__}
    assert sizes == {
        "placed": 8, "contains": 18, "recommends": 3, "bought_together": 9, "has_stop": 7,
        "delivers_order": 7, "delivers_to": 7, "route_to": 7,
    }
    twice = {"users": sample_data.users.union(sample_data.users.limit(1))}
    assert [(r[0], r[2]) for r in rows(graph.uniqueness_violations(twice))] == [("users", 2)]


def test_analysis_job(spark, tmp_path):
    where = ["--results", f"{tmp_path}/results", "--graph", f"{tmp_path}/graph"]
    place = ["--center-lat", "9.9326", "--center-lon", "-84.0796"]
    analysis.main([*where, *place, "--couriers", "2", "--database", "analisis_dw"])
    places = read_graph_files(spark, f"{tmp_path}/graph")["locations"]
    assert places.where("location_id = 'loc-central'").first()["latitude"] == 9.9326
    assert spark.read.csv(f"{tmp_path}/results/fact_sales", header=True).count() == 18
    assert spark.table("analisis_dw.route_assignments").count() == 7
    assert spark.table("analisis_dw.co_purchases").count() == 9
    pairs = spark.read.csv(f"{tmp_path}/graph/co_purchases", header=True)
    assert pairs.count() == 9
    first = spark.read.csv(f"{tmp_path}/results/peak_hours", header=True).first()
    assert first["order_hour"] == "12"


def test_load_from_a_command_line(spark, operational_sample, tmp_path, monkeypatch):
    monkeypatch.setattr(nightly, "read_source", lambda *_: operational_sample)
    nightly.main(["--changes", str(tmp_path / "c"), "--database", "mandado_dw"])
    assert spark.table("mandado_dw.fact_items_pedido").count() == 18


def test_credentials_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("COMANDA_JDBC_PASSWORD", "secret")
    monkeypatch.delenv("COMANDA_JDBC_USER", raising=False)
    assert arguments.from_environment(arguments.JDBC_ENVIRONMENT) == {"password": "secret"}


def test_analysis_names_a_failing_source(spark, tmp_path):
    where = ["--results", f"{tmp_path}/r", "--graph", f"{tmp_path}/g"]
    with pytest.raises(Exception):
        analysis.main([*where, "--source", "mongo"])
