"""Loads that readers see whole, buckets that stay, and digests that find changes."""

import os
import random
import re

import pytest
from conftest import rows
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.operators import graph, quality, star
from comanda.plans import graph_load, nightly
from comanda.sinks import buckets, files, warehouse
from comanda.sources.tables import Tables

DB = "cargas_dw"


def marked(source, mark):
    """The sample with a mark in every member and price, by which a load is told."""
    tables = dict(source.items())
    tables["users"] = tables["users"].withColumn("name", F.lit(f"u{mark}"))
    tables["restaurants"] = tables["restaurants"].withColumn("name", F.lit(f"r{mark}"))
    tables["products"] = tables["products"].withColumn("category", F.lit(f"c{mark}"))
    tables["order_items"] = tables["order_items"].withColumn("price", F.lit(mark).cast("decimal(18,2)"))
    tables["reservations"] = tables["reservations"].withColumn("party_size", F.lit(mark))
    return Tables(**tables)


JOINED = f"""
    SELECT DISTINCT u.nombre, r.nombre, p.categoria, cast(i.precio_unitario AS int), v.tamano_grupo
    FROM {DB}.fact_items_pedido i JOIN {DB}.dim_usuario u USING (usuario_key)
    JOIN {DB}.dim_restaurante r ON r.restaurante_key = i.restaurante_key
    JOIN {DB}.dim_producto p USING (producto_key)
    JOIN {DB}.dim_tiempo t ON t.tiempo_key = i.tiempo_key
    CROSS JOIN (SELECT DISTINCT tamano_grupo FROM {DB}.fact_reservaciones) v"""


def test_a_reader_between_any_two_steps_sees_one_load(spark, operational_sample, monkeypatch):
    nightly.load_star(spark, marked(operational_sample, 1), DB)
    pinned = star.read_star(spark, DB)
    seen, busy = [], []

    def look():
        if not busy:
            busy.append(True)
            seen.append(tuple(map(tuple, SQL(spark, JOINED).collect())))
            busy.pop()

    def watched(function):
        def call(*args, **options):
            look()
            found = function(*args, **options)
            look()
            return found

        return call

    SQL = SparkSession.sql
    with monkeypatch.context() as patch:
        changing = ("CREATE OR", "ALTER", "DROP", "INSERT")
        patch.setattr(SparkSession, "sql", lambda session, text, *more: (
            watched(SQL) if text.startswith(changing) else SQL)(session, text, *more))
        for name in ("write_version", "create_tables"):
            patch.setattr(nightly, name, watched(getattr(nightly, name)))
        for name in ("append", "drop_folder"):
            patch.setattr(warehouse, name, watched(getattr(warehouse, name)))
        # One task at a time, so that each step is looked at.
        patch.setattr(nightly, "_write_all", lambda tables, load, database: [
            nightly.write_version(df, name, load, database) for name, df in tables.items()])
        nightly.load_star(spark, marked(operational_sample, 2), DB)
    first, second = (("u1", "r1", "c1", 1, 1),), (("u2", "r2", "c2", 2, 2),)
    assert len(seen) > 20 and set(seen) == {first, second}
    assert seen.index(second) == len(seen) - seen[::-1].index(first)
    # A star that was read before stays of its load.
    assert pinned.dim_usuario.select("nombre").distinct().first()[0] == "u1"
    assert pinned.fact_items_pedido.select(F.max("precio_unitario")).first()[0] == 1


def test_a_failed_load_changes_nothing(spark, operational_sample, monkeypatch):
    nightly.load_star(spark, marked(operational_sample, 3), DB)
    before = warehouse.current_load(spark, warehouse.STAR, DB)

    def fail(*_):
        raise OSError("disk full")

    for step in ("write_facts", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(nightly, step, fail)
            with pytest.raises(OSError):
                nightly.load_star(spark, marked(operational_sample, 4), DB)
        assert warehouse.current_load(spark, warehouse.STAR, DB) == before
        assert [tuple(r) for r in spark.sql(JOINED).collect()] == [("u3", "r3", "c3", 3, 3)]
    nightly.load_star(spark, marked(operational_sample, 5), DB)
    assert len(warehouse.folders(spark, f"{DB}.dim_usuario__cargas")) == 2


def test_a_query_asks_the_pointer_once(spark, operational_sample):
    nightly.load_star(spark, operational_sample, DB)
    found = spark.sql(JOINED)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    asked = re.findall(r"carga#\d+L = (?:ReusedSubquery )?Subquery (subquery#\d+)", plan)
    assert len(asked) >= 5 and len(set(asked)) == 1


def test_other_columns_are_refused(spark):
    warehouse.write_tables({"uno": spark.range(3)}, "columnas_dw", "g")
    with pytest.raises(ValueError, match="other columns"):
        warehouse.write_tables({"uno": spark.range(3).withColumn("b", F.lit(1))}, "columnas_dw", "g")
    assert spark.table("columnas_dw.uno").count() == 3


def test_an_old_plain_table_becomes_a_view(spark):
    spark.sql("create database if not exists viejo_dw")
    spark.range(2).write.saveAsTable("viejo_dw.uno")
    assert warehouse.write_tables({"uno": spark.range(5)}, "viejo_dw", "g") == {"uno": 5}
    assert spark.table("viejo_dw.uno").count() == 5


def table(name="cosas", count=16):
    return buckets.BucketTable(name, ("id",), "cosas", "cubos_dw", count)


def put(spark, stored, new):
    load = warehouse.new_load(spark, stored.database)
    versions = stored.upsert(new, load)
    warehouse.publish(spark, stored.group, versions, load, stored.database)
    stored.drop_old(spark)
    return {v.part for v in versions}


def listed(spark, stored):
    """Files of the stored table with their times."""
    path, _ = warehouse._path(spark, f"{stored.database}.{stored.stored}")
    top = path.toUri().getPath()
    return {
        os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns
        for at, _, names in os.walk(top) for f in names if f.endswith(".orc")
    }


def test_upsert_writes_touched_buckets_only(spark):
    stored, kinds = table(), "id string, n long, t string"
    first = spark.createDataFrame([(f"k{i}", i, None) for i in range(200)], kinds)
    put(spark, stored, first)
    before, parts = listed(spark, stored), stored.parts(spark)
    new = spark.createDataFrame([("k7", 7, None), ("k8", -8, None), ("nuevo", 1, "x")], kinds)
    wanted = graph.upsert(first, new, "id")
    load = warehouse.new_load(spark, stored.database)
    versions = stored.upsert(new, load)
    # Written, not shown yet.
    assert sorted(rows(spark.table("cubos_dw.cosas"))) == sorted(rows(first))
    warehouse.publish(spark, stored.group, versions, load, stored.database)
    assert sorted(rows(spark.table("cubos_dw.cosas")), key=repr) == sorted(rows(wanted), key=repr)
    ids = {r.id: r.b for r in wanted.select("id", buckets.bucket_of(["id"], 16).alias("b")).collect()}
    touched, after = {ids["k8"], ids["nuevo"]}, stored.parts(spark)
    assert {b for b in after if after[b].part != getattr(parts.get(b), "part", None)} == touched
    now = listed(spark, stored)
    assert all(now[f] == t for f, t in before.items())
    assert len({f for f in now if f not in before}) >= len(touched)
    assert sum(v.rows for v in after.values()) == 201


def test_an_equal_upsert_writes_nothing(spark):
    stored = table("iguales")
    first = spark.createDataFrame([("a", None, 1.5), ("b", float("nan"), None)], "id string, x double, y double")
    parts = put(spark, stored, first)
    before = listed(spark, stored)
    assert put(spark, stored, first) == parts and listed(spark, stored) == before
    assert put(spark, stored, first.limit(0)) == parts


def test_upserts_equal_the_plain_ones(spark):
    stored, draw = table("azar", 8), random.Random(3)
    held = {}
    for _ in range(4):
        new = {f"k{draw.randrange(60)}": draw.randrange(3) for _ in range(20)}
        held |= new
        put(spark, stored, spark.createDataFrame(list(new.items()), "id string, n int"))
        assert dict(rows(spark.table("cubos_dw.azar"))) == held
    # Two loads stay, and no parts but theirs.
    kept = set()
    for load in warehouse.kept_loads(spark, stored.group, stored.database):
        kept |= {v.part for v in stored.parts(spark, load).values()}
    assert set(warehouse.folders(spark, f"cubos_dw.{stored.stored}")) == kept


def test_views_of_parts_read_listed_parts_only(spark):
    stored = table("podada")
    put(spark, stored, spark.createDataFrame([(f"k{i}", i) for i in range(50)], "id string, n int"))
    found = spark.table("cubos_dw.podada")
    assert found.count() == 50
    assert "parte" not in found.columns


def catalogue(spark, changed=()):
    price = F.col("id") % 7 + F.lit(0.5)
    for i in changed:
        price = F.when(F.col("id") == i, F.lit(99.5)).otherwise(price)
    columns = [F.concat(F.lit("p"), "id").alias("id"), F.lit("pan").alias("name"), F.lit("c").alias("category"),
               price.alias("price"), (F.col("id") % 3 > 0).alias("available")]
    return spark.range(500).select(*columns)


def scanned(df: DataFrame) -> list[tuple[int, int]]:
    """(files, rows) that each scan of a query reads."""
    df.collect()
    found = []

    def visit(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(plan.executedPlan())
        if "QueryStage" in name:
            return visit(plan.plan())
        if name.startswith("Scan"):
            metrics = plan.metrics()
            if metrics.contains("numFiles"):
                found.append((metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()))
        children = plan.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_one_changed_product_reads_one_bucket_of_both_sides(spark, tmp_path, monkeypatch):
    database, sides = "arbol_dw", []
    compare = quality.catalogue_changes

    def watched(before, after):
        sides.append((scanned(before), scanned(after)))
        return compare(before, after)

    monkeypatch.setattr(nightly, "catalogue_changes", watched)
    publish = lambda df: nightly.publish_catalogue(spark, df, database, str(tmp_path), 64)
    assert publish(catalogue(spark))
    assert publish(catalogue(spark)) is None
    folder = publish(catalogue(spark, [123]))
    (before, after) = sides[-1]
    per_bucket = 500 // 64 * 4
    assert len(before) == len(after) == 1
    assert before[0][0] == after[0][0] == 1
    assert 0 < before[0][1] < per_bucket and 0 < after[0][1] < per_bucket
    found = [(r.id, r.change, r.price_new) for r in spark.read.json(folder).collect()]
    assert found == [("p123", "changed", 99.5)]
    # What is remembered is the whole new catalogue.
    shown = spark.table(f"{database}.{nightly.SNAPSHOT}")
    assert sorted(rows(shown.select(*quality.CATALOGUE))) == sorted(rows(catalogue(spark, [123])))
    assert publish(catalogue(spark, [123])) is None


@pytest.mark.parametrize("seed", range(3))
def test_bucketwise_changes_equal_the_full_comparison(spark, seed):
    draw = random.Random(seed)
    old = catalogue(spark, draw.sample(range(500), 5))
    new = catalogue(spark, draw.sample(range(500), 9)).where(~F.col("id").isin(f"p{draw.randrange(500)}", "p3"))
    sides = [buckets.bucketed(df, "id", 64) for df in (old, new)]
    trees = [quality.digest_tree(df, 64) for df in sides]
    differing = quality.differing_buckets(*trees, 64)
    assert 0 < len(differing) < 20
    parts = [df.where(F.col(quality.BUCKET).isin(differing)) for df in sides]
    found, wanted = quality.catalogue_changes(*parts), quality.catalogue_changes(old, new)
    assert sorted(rows(found)) == sorted(rows(wanted))
    # Each level sums up the one below, and the root is the whole table's fingerprint.
    root = trees[0].where(F.col("nivel") == quality.tree_levels(64)).drop("nivel", "cubo")
    assert rows(root) == rows(quality.fingerprint(old))


def test_catalogues_without_rows(spark, tmp_path):
    publish = lambda df: nightly.publish_catalogue(spark, df, "vacio_cat", str(tmp_path), 8)
    assert publish(catalogue(spark))
    gone = spark.read.json(publish(catalogue(spark).limit(0)))
    assert gone.count() == 500 and {r.change for r in gone.collect()} == {"removed"}
    assert spark.table(f"vacio_cat.{nightly.SNAPSHOT}").isEmpty()


def test_graph_reload_writes_changed_buckets_only(spark, sample_data, tmp_path):
    from comanda.constants import SMALL_FLEET
    from comanda.operators import basket, routing

    routes = routing.route_assignments(sample_data.orders, SMALL_FLEET)
    pairs = basket.co_purchases(sample_data.order_items)
    files.export_graph(sample_data, pairs, routes, f"{tmp_path}/a")
    counts = graph_load.load(spark, f"{tmp_path}/a", "grafo_cubos", 8)
    before = {n: t.parts(spark) for n, t in graph_load.tables("grafo_cubos", 8).items()}
    renamed = sample_data.users.withColumn("name", F.when(F.col("user_id") == "u1", "Otra").otherwise(F.col("name")))
    later = Tables(**{**dict(sample_data.items()), "users": renamed})
    files.export_graph(later, pairs, routes, f"{tmp_path}/b")
    assert graph_load.load(spark, f"{tmp_path}/b", "grafo_cubos", 8) == counts
    after = {n: t.parts(spark) for n, t in graph_load.tables("grafo_cubos", 8).items()}
    moved = [(n, b) for n in after for b in after[n] if after[n][b].part != before[n][b].part]
    assert len(moved) == 1 and moved[0][0] == "node_users"
    assert spark.table("grafo_cubos.node_users").where("name = 'Otra'").count() == 1


def test_a_load_without_reservations(spark, operational_sample):
    tables = dict(operational_sample.items())
    tables["reservations"] = tables["reservations"].where("false")
    counts = nightly.load_star(spark, Tables(**tables), "sin_reservas_dw")
    assert counts["fact_reservaciones"] == 0 and counts["fact_items_pedido"] == 18


def test_a_look_up_skips_row_groups(spark):
    n = 60_000
    fields = {f.name: F.lit(None).cast(f.dataType) for f in warehouse.WAREHOUSE["fact_items_pedido"]}
    fields |= {
        "tiempo_key": F.lit(2026010112).cast("long"),
        "usuario_key": F.xxhash64(F.col("id") % 5000),
        "producto_key": F.xxhash64(F.lit("p"), F.col("id") % 30_000),
        "pedido_id": F.col("id").cast("string"),
    }
    made = spark.range(0, n, 1, 3).select(*[c.alias(name) for name, c in fields.items()])
    load = warehouse.new_load(spark, "busca_dw")
    assert warehouse.write_version(made, "fact_items_pedido", load, "busca_dw").rows == n
    stored = warehouse.read_load(spark, "fact_items_pedido", load, "busca_dw")
    key = made.select("usuario_key").first()[0]
    one = stored.where(F.col("usuario_key") == key).select("pedido_id")
    assert one.count() == 12
    assert sum(r for _, r in scanned(one)) <= n / 3
    product = stored.where(F.col("producto_key") == 7).select("pedido_id")
    assert product.count() == 0 and sum(r for _, r in scanned(product)) <= n / 3
