"""Business labels as column expressions. Conditions are tried top-down."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlark import constants as C
from ledgerlark.functions.text import contains_any, has_keyword, starts_with, strip, tidy
from ledgerlark.settings import Vocabulary


def first_label(rules: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds, else the default."""
    label = F.lit(default)
    for condition, name in reversed(rules):
        label = F.when(condition, name).otherwise(label)
    return label


def clean_type(invoice: Column, quantity: Column, price: Column) -> Column:
    """Transaction type of the clean table. A sale outranks every other reading of a line."""
    text = strip(invoice)
    cancelled, accounting = starts_with(text, "C"), starts_with(text, "A")
    return first_label(
        [
            ((quantity > 0) & (price > 0) & ~accounting & ~cancelled, C.SALE),
            (~accounting & (price < 0), C.NEGATIVE_PRICE),
            ((quantity > 0) & (price == 0), C.ZERO_PRICE),
            (~cancelled & ~accounting & (quantity < 0) & (price == 0), C.OPERATIONAL),
            (cancelled & (quantity < 0), C.RETURN),
            (accounting, C.ACCOUNTING),
        ],
        C.OTHER,
    )


def audit_type(invoice: Column, quantity: Column, price: Column) -> Column:
    """Transaction type of the raw audit. The invoice prefix outranks the amounts."""
    return first_label(
        [
            (starts_with(invoice, "A"), C.ACCOUNTING),
            (starts_with(invoice, "C") & (quantity < 0), C.RETURN),
            ((quantity < 0) & (price == 0), C.OPERATIONAL),
            ((quantity > 0) & (price == 0), C.ZERO_PRICE),
            ((quantity > 0) & (price > 0), C.SALE),
            (price < 0, C.NEGATIVE_PRICE),
        ],
        C.OTHER,
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Customer segment of three scores from 1 to 5."""
    return first_label(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 4) & (f >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "New / Promising"),
            ((r == 3) & (f >= 3), "Potential Loyalists"),
            ((r <= 2) & (f >= 4) & (m >= 4), C.AT_RISK_HIGH_VALUE),
            ((r <= 2) & (f >= 3), "At Risk"),
            ((r <= 2) & (f <= 2), "Hibernating"),
        ],
        "Needs Attention",
    )


def return_risk(rate: Column) -> Column:
    """Five return-risk tiers of a customer; an upper bound belongs to the next tier."""
    return first_label(
        [
            (rate == 0, "No Returns"),
            (rate < 0.05, "Low Return Risk"),
            (rate < 0.15, "Moderate Return Risk"),
            (rate < 0.30, "High Return Risk"),
        ],
        "Very High Return Risk",
    )


def strategic_class(tier: Column, risk: Column) -> Column:
    """Customer class of value tier and return risk."""
    top, risky = tier == "Very High Value", risk.isin(C.HIGH_RETURN_TIERS)
    return first_label(
        [
            (top & risky, C.HIGH_VALUE_HIGH_RISK),
            (top, "Strategic High Value"),
            ((tier == "High Value") & risky, "High Value / Return Risk"),
            (risk == "Very High Return Risk", "Severe Return Risk"),
        ],
        "Standard",
    )


def product_category(code: Column, description: Column) -> Column:
    """Product category of a stock code and its description."""
    code, text = F.upper(tidy(code)), F.upper(tidy(description))
    return first_label(
        [
            (code.isin(C.FEE_CODES), C.FEES),
            (code.isin(C.LOGISTICS_CODES), C.LOGISTICS),
            (code.isin(C.SAMPLE_CODES) | text.contains("SAMPLE"), C.SAMPLES),
            (text.contains("MANUAL"), C.FEES),
        ],
        C.MERCHANDISE,
    )


def association_type(first: Column, second: Column, vocabulary: Vocabulary = Vocabulary()) -> Column:
    """Type of an association, from the words in both descriptions."""
    a, b = F.upper(F.coalesce(first, F.lit(""))), F.upper(F.coalesce(second, F.lit("")))
    complementary = F.lit(False)
    for left, right in vocabulary.complementary:
        complementary = complementary | (a.contains(left) & b.contains(right))

    def both(terms):
        return contains_any(a, terms) & contains_any(b, terms)

    return first_label(
        [
            (complementary, C.COMPLEMENTARY),
            (both(vocabulary.coordinated), C.COORDINATED),
            (both(vocabulary.family), C.FAMILY),
        ],
        C.CROSS_SELL,
    )


def type_weight(kind: Column) -> Column:
    """Score weight of an association type."""
    pairs = [F.lit(part) for item in C.TYPE_WEIGHTS.items() for part in item]
    return F.create_map(*pairs)[kind]


def commercial_action(kind: Column) -> Column:
    """Commercial action of an association type."""
    return first_label([(kind == name, text) for name, text in C.ACTIONS.items()], C.DEFAULT_ACTION)


def recommendation(kind: Column) -> Column:
    """Advice for an association type."""
    return first_label([(kind == name, text) for name, text in C.ADVICE.items()], C.DEFAULT_ADVICE)


def description_quality(description: Column) -> Column:
    """Quality state of a tidy description."""
    return first_label(
        [
            (description == "", "Missing Description"),
            (has_keyword(description, C.QUALITY_KEYWORDS), "Operational / Dirty Description"),
        ],
        C.COMMERCIAL_DESCRIPTION,
    )


def product_return_risk(rate: Column) -> Column:
    """Return risk of a product; an upper bound belongs to its own bin, a missing rate has none."""
    return (
        F.when(rate <= 0.05, "Low").when(rate <= 0.15, "Moderate").when(rate <= 0.30, "High").when(rate > 0.30, "Very High")
    )


def product_class(validity: Column, net: Column, rate: Column) -> Column:
    """Strategic class of a product; a missing return rate needs review."""
    earning = (validity == "Valid") & (net > 0)
    return first_label(
        [
            (earning & (rate < 0.05), "Core Commercial Product"),
            (earning & (rate < 0.15), "Monitor Return Risk"),
            (earning & (rate >= 0.15), "High Return Risk"),
        ],
        "Review / Operational",
    )


def master_status(operational: Column, missing: Column, active: Column) -> Column:
    """State of a product in the product master."""
    return first_label(
        [
            (operational, "Operational / Adjustment"),
            (missing & ~active, "Inactive / Unmapped"),
            (missing & active, "Master Data Incomplete"),
            (~active, "Inactive / No Activity"),
        ],
        C.VALIDATED,
    )


def value_tier(net: Column, edges: tuple) -> Column:
    """Four product tiers by net revenue; an edge belongs to the tier below it."""
    top, high, established = edges
    return first_label([(net > top, C.TIER_1), (net > high, C.TIER_2), (net > established, C.TIER_3)], C.TIER_4)


def master_return_flag(status: Column, rate: Column) -> Column:
    """Return-risk flag of a validated product."""
    validated = status == C.VALIDATED
    return first_label(
        [
            (validated & (rate >= 0.30), "Critical"),
            (validated & (rate >= 0.15), "High"),
            (validated & (rate >= 0.05), "Moderate"),
        ],
        "Low / Not Applicable",
    )


def scope_reason(included: Column, status: Column, non_merchandise: Column) -> Column:
    """Why a product is inside or outside the executive universe."""
    return first_label(
        [
            (included, "Included"),
            (status == "Operational / Adjustment", "Operational / Adjustment"),
            (status == "Master Data Incomplete", "Missing Product Master Data"),
            (non_merchandise, "Non-Merchandise / Logistics / Fee"),
        ],
        "Other Review",
    )


def anomaly_severity(score: Column) -> Column:
    """Severity of the number of anomaly flags."""
    return first_label(
        [(score >= 3, "Critical Review"), (score == 2, "High Review"), (score == 1, "Monitor")], "Normal"
    )


def anomaly_action(severity: Column, description: Column, returns: Column) -> Column:
    """Recommended action for an audited product."""
    return first_label(
        [
            (severity == "Critical Review", "Validate product master and transaction history"),
            (severity == "High Review", "Investigate before executive reporting"),
            (description, "Validate product description / SKU mapping"),
            (returns, "Investigate return behaviour"),
        ],
        "No immediate action",
    )
