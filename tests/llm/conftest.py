import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))  # a module named conftest is loaded once
sys.path.insert(0, ROOT)


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The tables here are tiny; most of a test's time would be empty tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
