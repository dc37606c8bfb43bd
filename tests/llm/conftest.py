import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_docs import DOCS, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def few(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark


@pytest.fixture(scope="session")
def odd(few):
    return few.createDataFrame(odd_rows(), DOCS).coalesce(2)


@pytest.fixture(scope="session")
def none(few):
    return few.createDataFrame([], DOCS)
