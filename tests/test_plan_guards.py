"""Scale guards on the physical plans of the checked queries."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
# these run side effects (files, streams) while being built; covered elsewhere
SIDE_EFFECTS = {"csv_to_strings", "csv_quoted_newlines", "archive_expand", "warehouse_refresh", "incremental_plan", "manifest_files",
                "registered_tables", "schema_changes", "resumed_refresh", "concurrent_refreshes", "lazy_tables"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SIDE_EFFECTS))
def test_no_pairs_and_no_row_udfs(name, spark):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    assert "ReadSchema" in plan  # reads go through the parquet scan with a pruned schema


def test_filters_reach_the_scan(spark):
    plan = E.queries()["identify_due"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,49.0)" in plan
    # the lineitem scan reads only the three columns the stored catalog needs
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


PROJECTIONS = ["null_symbols", "sanitize_names", "folder_slug", "folder_slug_text", "display_title",
               "error_label", "typed_view", "archive_member", "archive_signature", "catalog_flatten",
               "frequency_days"]


@pytest.mark.parametrize("name", PROJECTIONS)
def test_scalar_logic_stays_in_codegen(name, spark):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # JVM-side and whole-stage codegen'd (from_json itself runs outside codegen)
    assert "*(1) Project" in plan or "*(2) Project" in plan, plan[:500]
