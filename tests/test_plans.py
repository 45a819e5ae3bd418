"""Properties of the physical plans that keep the jobs distributed."""

import contextlib
import io
import re

import pytest

from ledgerlark.catalog import RESULTS, workspace
from ledgerlark.operators.rollup import name_facts, order_facts, product_months, product_orders
from ledgerlark.plans import audits
from ledgerlark.plans.workspace import STAGES

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture(scope="module")
def tables(spark):
    return workspace(spark, FOLDER)


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stage_has_no_cross_join_and_no_python(tables, name):
    text = plan(STAGES[name](tables))
    assert not [node for node in FORBIDDEN if node in text]


def test_results_have_no_cross_join_and_no_python(tables):
    for name, result in RESULTS.items():
        text = plan(result(tables))
        assert not [node for node in FORBIDDEN if node in text], name


@pytest.mark.parametrize("rollup", [order_facts, name_facts, product_months])
def test_line_aggregations_hash_and_merge_early(tables, rollup):
    text = plan(rollup(tables.clean))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "partial_" in text and text.count("Exchange") == 1


def test_order_counts_shuffle_only_keys_and_flags(tables):
    text = plan(product_orders(tables.clean))
    scans = re.findall(r"clean-.*?ReadSchema: struct<(.*?)>", text)
    assert scans == ["InvoiceNo:string,StockCode:string,IsReturn:boolean,IsRevenueEligible:boolean"]
    assert "SortAggregate" not in text


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(RESULTS["q3_at_risk_customers"](tables))
    assert "EqualTo(Segment,At Risk High Value)" in text
    assert "FirstPurchase" not in text
    text = plan(RESULTS["q3_repeat_purchase"](tables))
    assert "ReadSchema: struct<SalesOrders:bigint>" in text


def test_top_lines_are_cut_before_the_shuffle(tables):
    text = plan(audits.most_negative_quantities(tables.raw, tables.sheets))
    assert text.count("TakeOrderedAndProject") == len(tables.sheets) == 2
    # the only sort is that of the lines taken
    below = text[text.index("TakeOrderedAndProject") :]
    assert "Sort " not in below and "Exchange" not in below


@pytest.mark.parametrize("name", ["q1_customer_concentration", "q2_merch_concentration", "q3_customer_concentration",
                                  "q4_customer_concentration", "q3_value_quartiles"])
def test_shares_and_tiles_read_a_numbered_stage(tables, name):
    text = plan(RESULTS[name](tables))
    assert "rangepartitioning(Net" not in text and "rangepartitioning(Gross" not in text


def test_the_headline_is_read_and_not_counted(tables):
    assert "Aggregate" not in plan(RESULTS["serve_headline"](tables))


def test_top_customers_are_not_sorted_whole(tables):
    assert "TakeOrderedAndProject" in plan(RESULTS["q1_top_customers"](tables))


@pytest.mark.parametrize("name", [
    "q1_data_quality", "q1_country", "q4_exec_kpis", "q4_country", "dash_executive_kpis", "dash_country",
    "audit_business_profile",
])
def test_distinct_counts_do_not_multiply_rows(tables, name):
    assert "Expand" not in plan(RESULTS[name](tables))
