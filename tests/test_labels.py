"""Classifiers and labels at their boundaries."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions import labels
from ledgerlark.functions.text import contains_any, number_or_zero, tidy

AMOUNTS = "invoice string, q long, p decimal(18,4)"


def _types(spark, rows, classify):
    df = spark.createDataFrame([(i, q, Decimal(str(p)) if p is not None else None) for i, q, p in rows], AMOUNTS)
    return [r[0] for r in df.select(classify(F.col("invoice"), F.col("q"), F.col("p"))).collect()]


# invoice, quantity, price, clean type, audit type
CASES = [
    ("536365", 6, 2.55, C.SALE, C.SALE),
    ("C536365", -1, 2.55, C.RETURN, C.RETURN),
    ("C536365", 1, 2.55, C.OTHER, C.SALE),
    ("C536365", -1, -2.55, C.NEGATIVE_PRICE, C.RETURN),
    ("C536365", -1, 0, C.RETURN, C.RETURN),
    ("A536365", 1, 0, C.ZERO_PRICE, C.ACCOUNTING),
    ("A536365", 1, -99.5, C.ACCOUNTING, C.ACCOUNTING),
    ("A536365", -1, 0, C.ACCOUNTING, C.ACCOUNTING),
    ("536365", -5, 0, C.OPERATIONAL, C.OPERATIONAL),
    ("536365", -5, 1, C.OTHER, C.OTHER),
    ("536365", 5, 0, C.ZERO_PRICE, C.ZERO_PRICE),
    ("536365", 0, 1, C.OTHER, C.OTHER),
    ("536365", 5, -1, C.NEGATIVE_PRICE, C.NEGATIVE_PRICE),
    ("  C536365", -1, 1, C.RETURN, C.OTHER),
    (None, 1, 1, C.SALE, C.SALE),
    ("536365", None, 1, C.OTHER, C.OTHER),
    ("536365", 1, None, C.OTHER, C.OTHER),
]


def test_clean_type(spark):
    assert _types(spark, [c[:3] for c in CASES], labels.clean_type) == [c[3] for c in CASES]


def test_audit_type(spark):
    assert _types(spark, [c[:3] for c in CASES], labels.audit_type) == [c[4] for c in CASES]


def _apply(spark, values, kind, label):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(label(F.col("x"))).collect()]


def test_return_risk_scales_differ(spark):
    rates = [0.0, 0.0499, 0.05, 0.15, 0.30, 1.2, None]
    assert _apply(spark, rates, "double", labels.return_risk)[:6] == [
        "No Returns", "Low Return Risk", "Moderate Return Risk", "High Return Risk", "Very High Return Risk",
        "Very High Return Risk",
    ]
    assert _apply(spark, rates, "double", labels.product_return_risk) == [
        "Low", "Low", "Low", "Moderate", "High", "Very High", None,
    ]
    flag = lambda rate: labels.master_return_flag(F.lit(C.VALIDATED), rate)
    assert _apply(spark, rates[:6], "double", flag) == [
        "Low / Not Applicable", "Low / Not Applicable", "Moderate", "High", "Critical", "Critical",
    ]
    unknown = lambda rate: labels.master_return_flag(F.lit("Inactive / Unmapped"), rate)
    assert set(_apply(spark, rates, "double", unknown)) == {"Low / Not Applicable"}


SEGMENTS = {
    (5, 5, 5): "Champions", (4, 4, 3): "Loyal Customers", (4, 3, 5): "Loyal Customers", (5, 2, 5): "New / Promising",
    (3, 3, 1): "Potential Loyalists", (3, 2, 5): "Needs Attention", (2, 4, 4): "At Risk High Value",
    (2, 4, 3): "At Risk", (1, 3, 5): "At Risk", (2, 2, 5): "Hibernating",
}


def test_rfm_segment(spark):
    df = spark.createDataFrame(list(SEGMENTS), "r int, f int, m int")
    got = [r[0] for r in df.select(labels.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert got == list(SEGMENTS.values())


def test_strategic_class(spark):
    cases = {
        ("Very High Value", "High Return Risk"): "High Value / High Return Risk",
        ("Very High Value", "No Returns"): "Strategic High Value",
        ("High Value", "Very High Return Risk"): "High Value / Return Risk",
        ("Mid Value", "Very High Return Risk"): "Severe Return Risk",
        ("High Value", "Low Return Risk"): "Standard",
    }
    df = spark.createDataFrame(list(cases), "t string, r string")
    assert [r[0] for r in df.select(labels.strategic_class(F.col("t"), F.col("r"))).collect()] == list(cases.values())


def test_product_category(spark):
    cases = {
        ("m", "Manual"): C.FEES, ("POST", "POSTAGE"): C.LOGISTICS, (" dot ", None): C.LOGISTICS, ("S", "x"): C.SAMPLES,
        ("123", "free samples"): C.SAMPLES, ("123", "Manual entry"): C.FEES, ("gift_0001_10", "voucher"): C.MERCHANDISE,
        ("85123A", None): C.MERCHANDISE,
    }
    df = spark.createDataFrame(list(cases), "c string, d string")
    assert [r[0] for r in df.select(labels.product_category(F.col("c"), F.col("d"))).collect()] == list(cases.values())


@pytest.mark.parametrize(
    "a, b, kind",
    [
        ("CAST IRON HOOK GARDEN FORK", "CAST IRON HOOK GARDEN TROWEL", C.COMPLEMENTARY),
        ("SET/6 COLLAGE PAPER CUPS", "SET/6 COLLAGE PAPER PLATES", C.COMPLEMENTARY),
        ("METAL SIGN,CUPCAKE SINGLE HOOK", "METAL SIGN,CUPCAKE TRIPLE HOOK", C.COORDINATED),
        ("green teacup", "pink teacup", C.COORDINATED),
        ("JUMBO BAG RED", "LUNCH BAG RED", C.FAMILY),
        ("WOODEN FRAME A", "WOODEN FRAME B", C.COMPLEMENTARY),
        ("CANDLE", None, C.CROSS_SELL),
    ],
)
def test_association_type(spark, a, b, kind):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(labels.association_type(F.col("a"), F.col("b"))).first()[0] == kind


def test_master_status(spark):
    cases = {
        (True, True, False): "Operational / Adjustment", (False, True, False): "Inactive / Unmapped",
        (False, True, True): "Master Data Incomplete", (False, False, False): "Inactive / No Activity",
        (False, False, True): C.VALIDATED,
    }
    df = spark.createDataFrame(list(cases), "o boolean, m boolean, a boolean")
    got = df.select(labels.master_status(F.col("o"), F.col("m"), F.col("a"))).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_value_tier_edges_belong_below(spark):
    tier = lambda net: labels.value_tier(net, (100000, 25000, 5000))
    assert _apply(spark, [100000.01, 100000.0, 25000.0, 5000.0, -1.0], "double", tier) == [
        C.TIER_1, C.TIER_2, C.TIER_3, C.TIER_4, C.TIER_4,
    ]


def test_keyword_lists_differ(spark):
    texts = ["Missing item", "adjust stock", "website order", "CARGO ORDER", "mailout"]
    quality = _apply(spark, texts, "string", lambda t: labels.has_keyword(t, C.QUALITY_KEYWORDS))
    master = _apply(spark, texts, "string", lambda t: labels.has_keyword(t, C.MASTER_KEYWORDS))
    anomaly = _apply(spark, texts, "string", lambda t: labels.has_keyword(t, C.ANOMALY_KEYWORDS))
    assert quality == [True, False, False, True, False]
    assert master == [False, True, False, True, False]
    assert anomaly == [True, True, True, True, True]


def test_text_helpers(spark):
    assert _apply(spark, ["\t a b \n", None], "string", tidy) == ["a b", ""]
    assert _apply(spark, ["1.5", "x", None], "string", number_or_zero) == [1.5, 0.0, 0.0]
    assert _apply(spark, ["CUPCAKE", "BOX"], "string", lambda t: contains_any(t, ["CUP", "JUG"])) == [True, False]


def test_score_and_advice_of_known_pairs(spark):
    # pair orders, lift, confidence, type, published score
    rows = [
        (147, 181.49592003263973, 0.8596491228070176, C.COMPLEMENTARY, 30.195878292418783),
        (194, 113.63867471045585, 0.8699551569506726, C.COMPLEMENTARY, 29.36501650423239),
    ]
    df = spark.createDataFrame(rows, "n long, lift double, conf double, kind string, score double")
    score = F.log1p("n") * F.log1p("lift") * F.col("conf") * labels.type_weight(F.col("kind"))
    for row in df.select(score.alias("ours"), "score", labels.commercial_action(F.col("kind")).alias("action")).collect():
        assert row.ours == pytest.approx(row.score, rel=1e-13)
        assert row.action == "Accessory / Complementary Recommendation"
