import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="8", shuffle_partitions=4, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def small(spark):
    from shelfcast.sources.stored_tables import StoredTables

    return StoredTables(spark, "/root/testdata/sf0.001")


def series(spark, units, extra=None, start="2024-01-01", key=("MI-006", "Retail", "PL-North")):
    """One weekly series with the given units, one row a week."""
    from pyspark.sql import functions as F

    rows = [(*key, i, None if u is None else float(u)) for i, u in enumerate(units)]
    frame = spark.createDataFrame(rows, "sku string, channel string, region string, i int, units_sold double")
    frame = frame.withColumn("week", F.date_add(F.lit(start).cast("date"), F.col("i") * 7)).drop("i")
    return frame.withColumns(extra or {})
