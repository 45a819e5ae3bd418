"""Every named result against its SQL twin over the test tables."""

import pytest
from check import connect, difference

import __spark_entry__ as driver
from ledgerlark.catalog import RESULTS
from oracle.sql import all_queries

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, TWINS = {name: query for name, query in driver.queries().items() if name in RESULTS}, all_queries()
# Results without rows on the smallest tables.
LATE = [
    "product_associations", "product_associations_heavy", "associations_top", "associations_top_frequency", "cross_sell",
    "cross_sell_summary", "cross_sell_summary_actions", "dash_cross_sell", "serve_cross_sell",
    "customer_risk_summary_high",
]


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_result_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result(spark, tables, name):
    assert difference(QUERIES[name](spark, FOLDER), tables, TWINS[name]) is None


@pytest.mark.parametrize("name", LATE)
def test_result_with_rows(spark, name):
    df = QUERIES[name](spark, LARGER)
    assert difference(df, connect(LARGER), TWINS[name]) is None
    assert not df.isEmpty()


def test_customers_without_invoice_numbers_stay(spark):
    value = QUERIES["customer_value_unnumbered"](spark, FOLDER)
    assert value.count() == QUERIES["customer_value"](spark, FOLDER).count()
    assert value.filter("SalesOrders = 0 AND AverageOrderValue IS NULL AND GrossRevenue > 0").count() > 0
    lines = QUERIES["product_intelligence_unnumbered"](spark, FOLDER).agg({"SalesLines": "sum"}).first()[0]
    assert lines < QUERIES["product_intelligence"](spark, FOLDER).agg({"SalesLines": "sum"}).first()[0]


def test_entry(spark):
    assert driver.entry(spark).count() == 1
