import os

import pytest

from __spark_entry__ import entry
from assayworks.plans.catalogue import REGISTRY
from assayworks.plans.oracles import ORACLES
from tests.oracle import connection, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_oracle(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == []
