import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def docs(spark):
    from fixtures import SCHEMA, documents

    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    from fixtures import SCHEMA

    return spark.createDataFrame([], SCHEMA)
