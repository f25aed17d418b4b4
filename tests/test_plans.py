"""Plans: what must and must not appear in them."""

import re

import pytest

from conftest import SF_DIR
from vulnlake.plans.queries import REGISTRY

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(query(spark, SF_DIR)) for name, query in REGISTRY.items()}


def test_no_query_leaves_the_jvm_or_multiplies_rows(plans):
    for name, text in plans.items():
        assert not any(word in text for word in PYTHON), name
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


@pytest.mark.parametrize("name", ["latest_wins", "batch_cleaned", "first_per_window", "metric_coverage", "event_batch_dedupe"])
def test_top_row_per_key_is_limited_before_the_shuffle(plans, name):
    text = plans[name]
    assert "WindowGroupLimit" in text and "Partial" in text


def test_every_window_has_partition_keys(plans):
    # A window over all rows would gather them in one task.
    for name, text in plans.items():
        for line in text.splitlines():
            if re.search(r"[ +*)]Window \[", line):
                assert re.search(r"\], \[[^\[\]]+\], \[", line), (name, line)


def test_scans_read_only_what_is_used(spark):
    text = plan(REGISTRY["monthly_overview"](spark, SF_DIR))
    schemas = [line for line in text.splitlines() if "lineitem.parquet" in line]
    assert schemas and all("l_extendedprice" not in s and "l_shipdate" not in s for s in schemas)


def test_filters_reach_the_scan(spark):
    text = plan(REGISTRY["log_summary"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,props:string>" in text.replace("\n", "")
