import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

from compare import compare, connect  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from conftest import plan_of  # noqa: E402
from hearthline.bindings import oracles, registered  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def only_jvm_joins(df):
    plan = plan_of(df)
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_its_sql(spark, tables, name):
    outcome = compare(spark, tables, SF, name, only_jvm_joins)
    assert outcome.startswith("ok"), outcome


def test_every_query_has_an_oracle():
    assert set(oracles()) == set(registered())


def test_entry(spark):
    assert entry(spark).count() > 0
