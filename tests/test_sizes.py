"""Plans that hold however large the tables are."""

import os

import pytest

from docmart.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["r4_dispatch", "r5_refine", "r5b_many_houses", "r7_amc_rules"])
def test_documents_with_a_house_are_not_sent_through_the_driver(spark, name):
    """Even where Spark takes the documents for a small table; the rules are one."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        plan = registry()[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [doc_id" in plan
    assert "BroadcastHashJoin [doc_id" not in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["t11b_side_columns", "t12b_side_columns"])
def test_side_tables_read_and_deal_their_cells_once(spark, name):
    """No join of the cells with themselves, and no exchange after the one that stacks a document's tables."""
    plan = registry()[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert plan.split("REPARTITION_BY_COL")[0].count("Exchange") == 1
