"""Every registered query against its SQL on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"
OWN = [group for group in entry.GROUPS if group.__name__.startswith("workload.")]
NAMES = sorted(name for group in OWN for name in group.QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return check.database(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert not check.compare(spark, con, name, SF_DIR).startswith("FAIL")


def test_every_query_has_its_sql():
    assert set(NAMES) == {name for group in OWN for name in group.ORACLES}


def test_entry(spark):
    assert entry.entry(spark).columns == ["rel_id", "root_id"]


@pytest.mark.parametrize("name", ["full_mapping_current", "closure_pairs", "components"])
def test_plans_have_no_python_and_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
