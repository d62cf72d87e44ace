import random

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents-like table of (doc_id, text) rows, with extra columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    def make(rows, clash=("o", "id", "node", "name", "key", "size", "h")):
        d = spark.createDataFrame(rows, "doc_id long, text string")
        return d.withColumns({c: F.lit(1) for c in clash})

    return make


@pytest.fixture
def rnd():
    return random.Random(7)
