from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Row, SparkSession  # noqa: E402
from pyspark.sql.types import StringType, StructField, StructType  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="strata-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="strata-case-")


MOCK_SCHEMA = StructType([
    StructField(c, StringType(), True)
    for c in ("name", "main_category", "sub_category", "ratings", "no_of_ratings",
              "discount_price", "actual_price")
])

def _product(name, main, sub, ratings, count, discount, actual):
    return Row(name=name, main_category=main, sub_category=sub, ratings=ratings, no_of_ratings=count,
               discount_price=discount, actual_price=actual)


# A small shop: five good listings, two of them of one kettle, and five that break one rule each.
MOCK_ROWS = [
    _product(" Oak Shelf ", "Furniture", "Shelves", "4.9", "2,005", "3,480", "4,350"),
    _product("Copper Kettle", "Kitchen", "Kettles", "3.9", "97", "1,100", "1,600"),
    _product("Copper Kettle", "KITCHEN", "Kettles", "4.1", "312", "₹1,150", "₹1,600"),
    _product("Wool Blanket", "Bedding", "Blankets", "3.6", "48", "820.50", "1,025.00"),
    _product("Clay Pot", "Garden", "Pots", "4.3", "150", "99", "132"),
    _product("Linen Apron", "Kitchen", "Textiles", None, "15", "240", "300"),
    _product("Desk Lamp", "Furniture", "Lamps", "4.0", "61", "-12", "75"),
    _product("Garden Hose", "Garden", "Watering", "5.6", "33", "410", "500"),
    _product(None, "Garden", "Tools", "4.4", "8", "90", "120"),
    _product("Gift Card", "Bedding", "Vouchers", "2.0", "5", "0", "0"),
]


@pytest.fixture()
def mock_df(spark):
    return spark.createDataFrame(MOCK_ROWS, MOCK_SCHEMA)


def as_bronze(df, batch_id="b-test", day="2024-01-01"):
    """Give a frame of product text columns the full bronze shape."""
    from pyspark.sql import functions as F

    from strata.schemas import SOURCE_COLUMNS
    from strata.sources.lineage import with_lineage

    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SOURCE_COLUMNS]
    return with_lineage(df.select(*cols), "mock", batch_id, day)
