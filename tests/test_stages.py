"""Stages on small hand-made tables: duplicates, nulls, ties, identities."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark import constants as C
from ledgerlark.functions.lookup import find_column, find_date_column, first_value
from ledgerlark.operators.cleaning import clean_transactions
from ledgerlark.operators.picks import first_names, first_row, modal_names
from ledgerlark.operators.profile import count_copies, repeated_hashes
from ledgerlark.operators.rollup import customer_facts, name_facts, order_facts, product_facts, product_months, product_orders, product_sums, roll_up
from ledgerlark.plans import baskets, cohorts, dashboard, rfm
from ledgerlark.plans.workspace import Workspace
from ledgerlark.schema import RAW
from ledgerlark.sources.landing import load_raw, read_table, register_view, write_table
from ledgerlark.sources.star_view import raw_sheets
from ledgerlark.storage import shared_folder

FOLDER = "/root/testdata/sf0.001"


SHEET_SCHEMA = T.StructType([*RAW.fields, T.StructField("SourceYear", T.StringType())])


def _sheets(spark, rows):
    """rows: invoice, code, description, quantity, day, price, customer, sheet"""
    start = datetime.datetime(2010, 1, 1, 8, 26)
    shaped = [
        (i, c, d, q, start + datetime.timedelta(days=day), Decimal(str(p)), cust, "UK", sheet)
        for i, c, d, q, day, p, cust, sheet in rows
    ]
    return spark.createDataFrame(shaped, SHEET_SCHEMA)


def _tx(spark, rows):
    raw = _sheets(spark, rows)
    return clean_transactions(raw, repeated_hashes(raw))


LINES = [
    ("1", "A", "LAMP", 2, 0, 5, 10, "S1"),
    ("1", "A", "LAMP", 2, 0, 5, 10, "S1"),  # exact copy, dropped
    ("1", "A", "LAMP", 2, 0, 5, 10, "S2"),  # same line in the other sheet, kept
    ("1", "B", None, 1, 0, 3, 10, "S1"),
    ("C2", "A", "LAMP", -1, 3, 5, 10, "S1"),
    ("3", "A", "lamp broken", 1, 0, 5, None, "S1"),
    ("4", None, "UNKNOWN", 1, 40, 7, 11, "S1"),
    ("A5", "D", "Adjust", 1, 5, -50, None, "S1"),
    ("C6", "A", "LAMP", 1, 5, 5, 10, "S1"),  # unclassified, dropped
]


def test_clean_transactions(spark):
    rows = _tx(spark, LINES).collect()
    assert len(rows) == 7
    assert sorted(r.SourceYear for r in rows if r.InvoiceNo == "1" and r.StockCode == "A") == ["S1", "S2"]
    assert {r.TransactionType for r in rows} == {C.SALE, C.RETURN, C.ACCOUNTING}
    assert all(r.IsRevenueEligible == r.IsCommercialSale == (r.TransactionType == C.SALE) for r in rows)


def test_roll_up_counts_invoices_once(spark):
    orders = order_facts(_tx(spark, LINES))
    total = roll_up(orders).first()
    assert (total.Orders, total.SalesOrders, total.ReturnOrders, total.Lines) == (5, 3, 1, 7)
    assert total.NetAll == total.GrossRevenue + total.ReturnValue - 50
    by_customer = {r.CustomerID: r for r in roll_up(orders, "CustomerID").collect()}
    assert set(by_customer) == {10, 11, None}
    assert by_customer[10].SalesOrders == 1 and by_customer[10].GrossRevenue == 23
    assert by_customer[None].Orders == 2 and by_customer[None].SalesOrders == 1


def test_product_facts_keep_a_null_code(spark):
    tx = _tx(spark, LINES)
    rows = {r.StockCode: r for r in product_facts(product_months(tx), product_orders(tx)).collect()}
    assert rows[None].Orders == 1 and rows[None].GrossRevenue == 7
    assert rows["A"].Orders == 3 and rows["A"].SalesOrders == 2 and rows["A"].ReturnedUnits == -1


def test_product_facts_of_sums_per_code_and_of_months_agree(spark):
    tx = _tx(spark, LINES)
    direct, monthly = (product_facts(sums(tx), product_orders(tx)) for sums in (product_sums, product_months))
    assert direct.dtypes == monthly.dtypes
    assert sorted(map(str, direct.collect())) == sorted(map(str, monthly.collect())) and direct.count() == 4


def test_products_and_baskets_take_no_table_twice_or_needlessly(spark):
    tables = Workspace(_sheets(spark, LINES))
    assert tables.taxonomy.count() == 2 and tables.basket.count() == 2
    assert "product_months" not in tables._tables and "members" in tables._tables


def test_name_picks(spark):
    lines = [
        ("9", "A", "ZED", 1, 5, 1, 1, "S1"), ("8", "A", "ALT", 1, 5, 1, 1, "S1"), ("7", "A", "ZED", 1, 9, 2, 1, "S1"),
        ("7", "B", "B1", 1, 1, 1, 1, "S1"), ("6", "B", "B2", 1, 1, 1, 1, "S1"), ("6", "C", None, 1, 1, 1, 1, "S1"),
        ("5", None, "N", 1, 1, 1, 1, "S1"),
    ]
    tx = _tx(spark, lines)
    names = name_facts(tx)
    assert {r.StockCode: r.Description for r in modal_names(names).collect()} == {"A": "ZED", "B": "B1"}
    # Same first date for A and B: the smaller invoice number decides.
    assert {r.StockCode: r.Description for r in first_names(names, tx).collect()} == {"A": "ALT", "B": "B2", None: "N"}


def test_first_row(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, n int, t string")
    assert sorted(tuple(r) for r in first_row(df, "k", "n").collect()) == [("a", 1, "y"), ("b", 3, None)]


def test_cohorts(spark):
    lines = [("1", "A", "x", 1, 0, 5, 1, "S1"), ("2", "A", "x", 1, 40, 5, 1, "S1"), ("3", "A", "x", 1, 0, 5, 2, "S1"),
             ("4", "A", "x", 1, 45, 7, 3, "S1")]
    cells = cohorts.cohort_retention(order_facts(_tx(spark, lines))).collect()
    got = {(r.CohortMonth.month, r.CohortIndex): (r.ActiveCustomers, r.CohortSize, r.RetentionRate, r.Revenue) for r in cells}
    assert got == {(1, 1): (2, 2, 100.0, 10.0), (1, 2): (1, 2, 50.0, 5.0), (2, 1): (1, 1, 100.0, 7.0)}


def test_rfm_single_customer(spark):
    row = rfm.customer_rfm(customer_facts(order_facts(_tx(spark, LINES[:1])))).first()
    assert (row.Recency, row.Frequency, row.Monetary) == (1, 1, 10)
    assert row.Segment in {"New / Promising", "Champions"}


def test_cross_sell_defaults(spark):
    columns = (
        "ProductA string, ProductB string, PairOrders long, Support double, ProductAOrders long, ProductBOrders long, "
        "Confidence_A_to_B double, Confidence_B_to_A double, Lift double, ProductA_Description string, ProductB_Description string"
    )
    rows = [
        ("1", "2", 147, 0.1, 170, 170, 0.86, 0.85, 181.0, "GARDEN FORK", "GARDEN TROWEL"),
        ("3", "4", 60, 0.1, 90, 90, 0.65, 0.65, 20.0, "JUMBO BAG RED", "JUMBO BAG BLUE"),
        ("5", "6", 60, 0.1, 90, 90, 0.65, 0.65, 20.0, "CANDLE", "MIRROR"),
        ("7", "8", 49, 0.1, 60, 60, 0.80, 0.80, 50.0, "CANDLE", "MIRROR"),
        ("9", "A", 60, 0.1, 60, 60, 0.59, 0.80, 50.0, "CANDLE", "MIRROR"),
        ("B", "C", 60, 0.1, 60, 60, 0.80, 0.80, 9.9, "CANDLE", "MIRROR"),
    ]
    scored = baskets.scored_opportunities(spark.createDataFrame(rows, columns))
    assert tuple(baskets.cross_sell_funnel(scored).first()) == (3, 2, 2)
    best = baskets.cross_sell(scored).orderBy("ExecutiveRank").collect()
    assert [(r.ExecutiveRank, r.ProductA, r.AssociationType) for r in best] == [(1, "1", C.COMPLEMENTARY), (2, "5", C.CROSS_SELL)]


def test_identities(spark):
    w = Workspace(raw_sheets(spark, FOLDER))
    total = roll_up(w.orders).first()
    by_month = roll_up(w.orders, "Month").agg(F.sum("GrossRevenue"), F.sum("ReturnValue")).first()
    by_country = roll_up(w.orders, "Country").agg(F.sum("GrossRevenue"), F.sum("ReturnValue")).first()
    assert tuple(by_month) == tuple(by_country) == (total.GrossRevenue, total.ReturnValue)
    last = w.value.orderBy(F.desc("RevenueRank")).first()
    assert last.RevenueRank == w.value.count() and last.CumulativeRevenuePct == pytest.approx(100.0)
    assert w.intelligence.agg(F.sum("RevenueShare")).first()[0] == pytest.approx(100.0)
    assert w.scope.agg(F.sum("RevenueShare")).first()[0] == pytest.approx(1.0)
    assert w.cohorts.filter("CohortIndex = 1 AND RetentionRate <> 100").count() == 0


def test_csv_round_trip_with_awkward_text(spark):
    rows = [("1", "A", 'say "hi", twice', 2, 0, "5.1234", 10, "S1"), ("2", "B", " padded ", -1, 1, "-0.5", None, "S2")]
    df = _sheets(spark, rows)
    folder = f"{shared_folder(spark)}/test-csv"
    write_table(df, folder, "csv", partition_by="SourceYear")
    back = load_raw(spark, {s: f"{folder}/SourceYear={s}" for s in ("S1", "S2")}).select(*df.columns)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def _landing_file(spark, name, lines):
    path = f"{shared_folder(spark)}/{name}"
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


def test_customer_number_written_as_float(spark):
    lines = [HEADER, "1,A,LAMP,6,2010-12-01 08:26:00,2.55,17850.0,UK", "2,A,,6,2010-12-01 08:26:00,2.55,,UK",
             "3,A, x ,6,2010-12-01 08:26:00,2.55,17851,UK"]
    rows = load_raw(spark, {"S": _landing_file(spark, "float-customer", lines)}).orderBy("Invoice").collect()
    assert [r["Customer ID"] for r in rows] == [17850, None, 17851]
    assert [r["Description"] for r in rows] == ["LAMP", None, " x "]
    assert rows[0].InvoiceDate == datetime.datetime(2010, 12, 1, 8, 26)


def test_bad_csv_value_stops_the_job(spark):
    lines = [HEADER, "1,A,LAMP,six,2010-12-01 08:26:00,2.55,1,UK"]
    with pytest.raises(Exception, match="(?i)malformed"):
        load_raw(spark, {"S": _landing_file(spark, "bad-value", lines)}).collect()


@pytest.mark.parametrize("values", ["six,2010-12-01 08:26:00,2.55,1", "6,soon,2.55,1", "6,2010-12-01 08:26:00,2.555555,1",
                                    "6,2010-12-01 08:26:00,2.55,12346.4", "6,2010-12-01 08:26:00,two,1"])
def test_csv_misfit_stops_jobs_that_do_not_read_its_column(spark, values):
    raw = load_raw(spark, {"S": _landing_file(spark, "misfit", [HEADER, f"1,A,LAMP,{values},UK"])})
    with pytest.raises(Exception, match="(?i)malformed|parsed"):
        raw.count()
    with pytest.raises(Exception, match="(?i)malformed|parsed"):
        raw.groupBy("Country").count().collect()


def test_csv_line_breaks_in_quotes(spark):
    df = _sheets(spark, [("1", "A", "two\nlines", 2, 0, "5.1234", 10, "S1"), ("2", "B", "one", 1, 0, "1", None, "S1")])
    folder = f"{shared_folder(spark)}/test-csv-breaks"
    write_table(df, folder, "csv", partition_by="SourceYear")
    sheets = {"S1": f"{folder}/SourceYear=S1"}
    back = load_raw(spark, sheets, multi_line=True).select(*df.columns)
    assert back.count() == 2 and sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(Exception, match="(?i)malformed"):
        load_raw(spark, sheets).count()


def test_csv_needs_a_schema(spark):
    with pytest.raises(ValueError):
        read_table(spark, "/nowhere", fmt="csv")


def test_register_view(spark):
    assert register_view(spark.range(3), "three").count() == 3


def test_lookups(spark):
    df = spark.createDataFrame([("2010-01-01", 5, None), ("2010-02-01", 6, 2.0), ("2010-03-01", 7, 1.0)], "d string, Net_Revenue int, x double")
    assert find_column(df, ["NetRevenue", "net_revenue"]) == "Net_Revenue"
    assert find_column(df, ["absent"]) is None
    assert find_date_column(df, ["Month"]) == "d"
    assert find_date_column(df.select("x"), ["Month"]) is None
    assert [r[0] for r in df.orderBy("d").select(first_value(df, ["gone", "x"], 9.0)).collect()] == [9.0, 2.0, 1.0]
    assert [r[0] for r in df.select(first_value(df, ["gone"], 3)).collect()] == [3, 3, 3]


def test_serving_variants(spark):
    country = spark.createDataFrame([("UK", 5.0), ("FR", 7.0), (" DE ", 6.0)], "Country string, net_revenue double")
    assert [r.Country for r in dashboard.top_markets(country, n=2).collect()] == ["DE", "FR"]
    assert [r.Country for r in dashboard.top_markets(country, "DE").collect()] == ["DE"]
    segments = spark.createDataFrame([("a",), ("a",), ("b",)], "Segment string")
    assert [tuple(r) for r in dashboard.segment_value(segments).collect()] == [("a", 2), ("b", 1)]
    assert tuple(dashboard.risk_summary(country.select("Country")).first()) == (3, 0.0)


def test_count_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "n int, t string")
    assert count_copies(df, repeated_hashes(df)).first()[0] == 3
    assert count_copies(df.distinct(), repeated_hashes(df)).first()[0] == 0
