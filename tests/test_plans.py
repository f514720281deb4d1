"""Plan-shape guards for the scale properties the design relies on."""

import re

import pytest

from parcelle.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_cached_frames(spark):
    spark.catalog.clearCache()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [
    "clean_sales", "building_sales", "land_sales", "sale_points", "row_metrics",
    "missing_partitions", "manifest_summary", "region_filter", "json_pages", "flatten_json",
])
def test_no_cartesian_or_nested_loop(spark, key):
    text = plan(REGISTRY[key](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_clean_sales_reads_each_table_once_and_combines_map_side(spark):
    text = plan(REGISTRY["clean_sales"](spark, SF))
    for table in ["lineitem", "orders", "customer", "nation", "part"]:
        assert len(re.findall(rf"{table}\.parquet", text)) == 1, table
    # Only used columns are read from the line items.
    scan = next(l for l in text.splitlines() if "lineitem.parquet" in l)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint," in scan
    assert "l_extendedprice" not in scan and "l_shipdate" not in scan
    # The land-use list is collected above a partial (sale, use) aggregate,
    # never straight over raw lines.
    lines = text.splitlines()
    partial_collect = next(i for i, l in enumerate(lines) if "partial_collect_list" in l)
    below = "\n".join(lines[partial_collect + 1:])
    assert re.search(r"HashAggregate\(keys=\[[^\]]*nature_culture", below)
    assert "partial_count(1)" in below


def test_building_sales_has_no_holistic_aggregate(spark):
    text = plan(REGISTRY["building_sales"](spark, SF))
    assert "collect_list" not in text
    assert text.count("Exchange hashpartitioning(id_mutation") == 1
