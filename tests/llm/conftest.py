import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def odd_docs(spark):
    import odd

    return spark.createDataFrame(odd.rows(), odd.SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """(doc_id, text) of the small table, for brute-force versions."""
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
