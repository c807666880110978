"""Plan shape checks: no pair tables, pushdown reaches the
scan, Python only where intended."""

import pytest

from gleaner.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
# these run streams or write tables while being built; their operators are
# covered by test_pipeline / test_operators
EAGER = {"T1_T2_T3_pipeline_load", "T4_new_only_stream", "S9_lake_scan_compact", "S6_applications_table",
         "S7_vector_collection", "S1_S2_publish_read_topics", "S3_replay", "M7_M8_load_record",
         "A3_A4_budget_stream", "A6_rate_audit_stream", "S10_S11_segments", "E7_lookup_clustered", "S8_vector_delete_clustered",
         "E1_embed_chunks"}
PYTHON_PASSES = {"M3_pack_unpack_html", "H6_C9_detail_fields", "E4_cosine_top_k", "E5_approx_top_k",
                 "E4_cosine_top_k_rows", "E5_index_top_k", "E5_index_exact_top_k"}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pair_tables_and_python_only_where_intended(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    has_python = any(k in p for k in ("MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas",
                                         "FlatMapCoGroupsInPandas"))
    assert has_python == (name in PYTHON_PASSES), name


def test_pushdown_and_pruning(spark):
    p = plan(spark, "Q2_where")
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in p


def test_one_python_pass_for_detail_walk(spark):
    p = plan(spark, "H6_C9_detail_fields")
    assert p.count("MapInPandas") == 1 and "ArrowEvalPython" not in p


def test_top_k_is_window_limited(spark):
    p = plan(spark, "E4_cosine_top_k")
    assert "WindowGroupLimit" in p


def test_cleaning_is_codegen_only(spark):
    p = plan(spark, "C17_clean_postings")
    assert "Python" not in p and "MapInPandas" not in p
