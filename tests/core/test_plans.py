"""The plans of typical queries: filters and columns reach the scan, shuffles are as few as the query needs, nothing is Cartesian."""

import pytest
from pyspark.sql import functions as F

from corvid import queries as own
from corvid.operators.viewer import keys_in
from corvid.plans.review import review
from corvid.registry import load


@pytest.fixture
def plan(spark, sf):
    return lambda name: review(own.queries()[name](spark, sf))


def test_pushdown(spark, sf, plan):
    p = plan("pruned_range_lookup")
    assert any(f.startswith("GreaterThanOrEqual(l_orderkey") for f in p.pushed) and p.shuffles == 0
    assert set(p.read) == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}
    few = review(keys_in(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", [1, 2]))
    assert any(f.startswith("In(o_custkey") for f in few.pushed) and few.shuffles == 0


def test_shuffles(plan):
    assert plan("pricing_summary").shuffles == 1
    assert plan("dedupe_latest").shuffles == 1
    assert plan("supersession").shuffles <= 2
    assert plan("sample_modulo_md5").shuffles == 0
    assert plan("merge_upsert").shuffles == 1


def test_no_cartesian_and_python_where_meant(plan):
    python = {"html_to_text", "html_tables", "page_furniture", "reflow", "section_spans", "note_spans", "table_regions", "lexical_classify", "form_records"}
    for name in ("setop_expression", "delta_changed_rows", "plan_diff_full_outer", "merge_scoped_mask", "size_band_by_median", "quarter_unaccumulate", "term_stats", "chunk_documents", "longest_prefix_match", "family_assignment", "collocations"):
        p = plan(name)
        assert not p.cartesian and (p.python > 0) == (name in python)
    assert plan("html_to_text").python == 1


def test_columns_read(spark, sf, plan):
    assert set(plan("top_values").read) == {"o_orderpriority"}
    assert review(load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.sum("l_quantity"))).read == ("l_quantity", "l_returnflag")
