"""Every registered query against its SQL twin, at the smallest scale."""

import pytest
from oracle import both, connect

import tidemark.plans.catalogue  # noqa: F401
import tidemark.plans.pipelines  # noqa: F401
import tidemark.plans.records  # noqa: F401
import tidemark.plans.relational  # noqa: F401
import tidemark.plans.resolution  # noqa: F401
import tidemark.plans.texts  # noqa: F401
from tidemark.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got, want = both(spark, con, QUERIES[name], ORACLES[name])
    assert got == want
