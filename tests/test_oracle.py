"""Every registered query against the SQL stating its result, over whole tables."""

from __future__ import annotations

import os

import pytest

from siltstone.workload import catalog
from tests.compare import differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_states_its_result():
    assert set(catalog.queries()) == set(catalog.oracles())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    assert differences(catalog.queries()[name](spark, SF_DIR), catalog.oracles()[name], SF_DIR) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
