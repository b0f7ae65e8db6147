"""Plans keep their filters at the scan and join without products."""

import os

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="data folder missing")
QUERIES = contract.queries()


def plan(spark, key):
    return QUERIES[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["V01", "V02", "V11", "V12", "V13", "V17", "Q13", "Q25", "Q28", "Q34", "D46", "E09", "E11"])
def test_no_product_join(spark, key):
    text = plan(spark, key)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_monthly_volume_reads_only_its_columns(spark):
    text = plan(spark, "Q01")
    assert "lineitem" not in text  # the child tables feed no column of the result
    assert "o_totalprice" not in text


def test_top_n_is_a_distributed_top_k(spark):
    assert "TakeOrderedAndProject" in plan(spark, "P12b")
    assert "WindowGroupLimit" in plan(spark, "Q03")


def test_patient_filter_reaches_the_scans(spark):
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,1)]" in plan(spark, "P02")


@pytest.mark.parametrize("key", [name for name in QUERIES if name[:3] in ("P02", "P03", "P05", "P06", "P07", "P10", "P11") or name == "P04a"])
def test_child_facts_are_cut_before_they_are_aggregated(spark, key):
    lines = plan(spark, key).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*("))
    cuts = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    assert cuts
    for cut in cuts[-1:]:
        above = [line for line in lines[:cut] if depth(line) < depth(lines[cut])]
        assert any("HashAggregate" in line for line in above)


@pytest.mark.parametrize("key", ["V02", "V04", "V05", "V06"])
def test_names_of_small_dimensions_are_attached_last(spark, key):
    """Joins by large keys lie below the one that attaches the hospital, so they do not shuffle its name."""
    lines = QUERIES[key](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    joins = [line for line in lines if "Join " in line]
    hospital = min(joins, key=depth)
    assert "HospitalID" in hospital and "LeftOuter" not in hospital  # the children are joined further down
