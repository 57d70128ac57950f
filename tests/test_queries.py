import os
import re

import pytest

import __spark_entry__ as entry_module
from workload.check import compare, oracle_connection
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    registered = set(entry_module.queries())
    assert set(QUERIES) <= registered
    # Anything else comes from the optional operator package and is named op<N>_... or pipeline.
    assert all(re.fullmatch(r"op\d+_\w+|pipeline", name) for name in registered - set(QUERIES))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    assert compare(spark, oracle, name, SF_DIR) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert "label_json" in df.columns and df.count() > 0
