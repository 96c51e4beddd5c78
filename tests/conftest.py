import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from comanda.session import prepare  # noqa: E402
from comanda.sources import sample  # noqa: E402
from comanda.sources.normalise import normalise  # noqa: E402
from comanda.sources.tables import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def raw_sample(spark):
    return sample.load(spark)


@pytest.fixture(scope="session")
def sample_data(raw_sample):
    return normalise(raw_sample)


@pytest.fixture(scope="session")
def operational_sample(spark, sample_data):
    """The sample under operational column names, for the star."""
    d = sample_data
    restaurants = spark.createDataFrame(
        [(f"r{i}", f"Casa {i}", f"Calle {i}", 40) for i in (1, 2, 3)],
        "id string, name string, address string, capacity int",
    )
    return Tables(
        users=d.users.selectExpr(
            "user_id id", "name", "'client' role", "timestamp '2026-01-02 03:04:05' created_at",
            "referred_by", "'secret' password",
        ),
        products=d.products.selectExpr(
            "product_id id", "name", "category", "price", "true available", "'r1' restaurant_id"
        ),
        orders=d.orders.selectExpr(
            "order_id id", "user_id", "restaurant_id", "status", "false pickup", "created_at",
            "delivery_latitude", "delivery_longitude", "zone",
        ),
        order_items=d.order_items.selectExpr(
            "order_id || product_id id", "order_id", "product_id", "quantity", "unit_price price"
        ),
        reservations=d.reservations.selectExpr(
            "reservation_id id", "user_id", "restaurant_id", "reservation_time date", "party_size",
            "status",
        ),
        restaurants=restaurants,
    )


def rows(df):
    return [tuple(row) for row in df.collect()]
