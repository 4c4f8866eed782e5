"""Every registered query of the library stays JVM-side: no Python UDF nodes, no RDD
scans, no cartesian / nested-loop joins in its physical plan. (Corpus operators that
are not native choose their style freely.)"""

import pytest

import __spark_entry__ as entry
from conftest import plan_text

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "PythonMapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD",
             "MapPartitions")


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_plan_is_jvm_side(spark, name):
    plan = plan_text(entry.queries()[name](spark, SF), "simple")
    assert not [op for op in FORBIDDEN if op in plan], plan
