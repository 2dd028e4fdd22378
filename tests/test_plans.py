"""What no registered query may do."""

import re

import pytest

from pointmill.plans.queries import QUERIES

WITH_PYTHON_SCAN = {"ply_scan", "ply_scan_ascii", "ply_limit"}
# Training and scoring by Spark ML; its vector functions are JVM UDFs.
TRAINED = {"classify_voxels", "model_quality", "model_reload"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINED))
def test_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert bad not in plan
    python = re.findall(r"\w*Python\w*|ArrowEval\w*|MapInArrow\w*", plan)
    assert not python or name in WITH_PYTHON_SCAN
    # Min and max of whole rows are taken over the version log, a few rows.
    assert "SortAggregate" not in plan or name == "version_bounds"


def test_windows_over_series_are_sliced(spark, sf_dir):
    plan = QUERIES["counter_rate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    frames = re.findall(r"windowspecdefinition\((_series#\d+), (\S+?)#", plan)
    # Row-level frames are per slice; those over a whole series are ordered by the slice.
    assert frames and {second for _, second in frames} == {"_slice"}
