"""Plan shapes that have to hold whatever the data's size."""

import pytest

from tallymart.plans.catalogue import QUERIES


def plan_lines(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line.lstrip(" :+-*(0123456789)") for line in text.splitlines()]


@pytest.mark.parametrize("name", QUERIES)
def test_no_pairing_and_no_rows_gathered_in_one_task(spark, sf_dir, name):
    lines = plan_lines(QUERIES[name](spark, sf_dir))
    assert not [line for line in lines if "NestedLoop" in line or "Cartesian" in line]
    # Only partial aggregates may meet in a single partition.
    gathered = [lines[i + 1] for i, line in enumerate(lines) if "SinglePartition" in line]
    assert all("Aggregate(" in line and "partial_" in line for line in gathered), gathered
    assert not [line for line in lines if "BatchEvalPython" in line or "InPandas" in line or "ArrowEvalPython" in line]


def test_scans_read_only_the_columns_they_need(spark, sf_dir, capsys):
    QUERIES["kpi_scorecard"](spark, sf_dir).explain("formatted")
    schemas = [line for line in capsys.readouterr().out.splitlines() if line.startswith("ReadSchema")]
    lineitem = [line for line in schemas if "l_orderkey" in line]
    # The contact rollup is not needed and is not read; the outcome pivot takes three columns.
    assert lineitem == ["ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>"]


def test_the_quarters_come_from_the_episodes_alone(spark, sf_dir, capsys):
    QUERIES["kpi_quarterly"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_latest_year_filter_goes_below_the_roll_up(spark, sf_dir):
    lines = plan_lines(QUERIES["condition_gaps"](spark, sf_dir))
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "l_partkey" in line)
    assert any("scalar-subquery" in line.lower() or "Subquery" in line for line in lines[:scan])
    assert "Aggregate" not in lines[scan - 1]
