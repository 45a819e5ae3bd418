"""Fixed business values: labels, code sets, keyword lists and thresholds."""

# Transaction types.
SALE = "Normal Sale"
RETURN = "Cancellation / Return"
ACCOUNTING = "Accounting Adjustment"
OPERATIONAL = "Operational Adjustment"
ZERO_PRICE = "Zero-Price Transaction"
NEGATIVE_PRICE = "Negative Price Adjustment"
OTHER = "Other"

# The types that the clean table holds.
CLEAN_TYPES = [SALE, RETURN, ACCOUNTING, OPERATIONAL, ZERO_PRICE, NEGATIVE_PRICE]

# Product categories and the codes that decide them.
MERCHANDISE = "Merchandise"
FEES = "Fees / Adjustments"
LOGISTICS = "Logistics / Postage"
SAMPLES = "Samples"
FEE_CODES = ["M", "AMAZONFEE", "BANK CHARGES", "D"]
LOGISTICS_CODES = ["POST", "DOT"]
SAMPLE_CODES = ["S"]

# Codes outside the executive merchandise universe (case-sensitive).
NON_MERCHANDISE_CODES = [
    "POST", "DOT", "AMAZONFEE", "BANK CHARGES", "D", "S", "M",
    "gift_0001_10", "gift_0001_20", "gift_0001_30", "gift_0001_40", "gift_0001_50",
    "gift_0001_60", "gift_0001_70", "gift_0001_80", "gift_0001_90", "gift_0001_100",
]

# Keyword lists. The three differ on purpose.
QUALITY_KEYWORDS = [
    "damaged", "damage", "broken", "smashed", "wonky", "wrongly marked", "adjustment", "reverse",
    "website fixed", "quick fix", "amazon", "cargo order", "missing", "amendment", "thrown away",
    "throw away", "unsaleable", "destroyed", "bad debt",
]
MASTER_KEYWORDS = [
    "adjust", "damaged", "damage", "broken", "smashed", "wonky", "wrongly marked", "reverse",
    "website fixed", "quick fix", "amazon", "cargo order", "amendment", "thrown away", "throw away",
    "unsaleable", "destroyed", "bad debt",
]
ANOMALY_KEYWORDS = [
    "adjust", "adjustment", "damaged", "damage", "broken", "smashed", "wonky", "wrongly", "reverse",
    "website", "quick fix", "amazon", "cargo", "amendment", "mailout", "thrown away", "throw away",
    "unsaleable", "destroyed", "bad debt", "missing",
]

# Vocabulary that decides the type of a product association.
COMPLEMENTARY_TERMS = [
    ("BICYCLE", "PUNCTURE"), ("PUNCTURE", "BICYCLE"), ("FORK", "TROWEL"), ("TROWEL", "FORK"),
    ("CUP", "PLATE"), ("PLATE", "CUP"), ("FRAME", "FRAME"),
]
COORDINATED_TERMS = ["CUP", "PLATE", "BOWL", "JUG", "TEACUP", "TEA PLATE", "TROWEL", "FORK", "CUTLERY"]
FAMILY_TERMS = [
    "JUMBO BAG", "LUNCH BAG", "CHILDRENS", "KIDS", "HERB MARKER", "EGG COSY", "RAIN MAC", "TEA PLATE",
    "TEACUP", "CHARLOTTE BAG",
]

# Association types, score weights, actions and advice.
COMPLEMENTARY = "Complementary Cross-Sell"
COORDINATED = "Coordinated Set"
FAMILY = "Variant / Product Family"
CROSS_SELL = "Cross-Sell"
TYPE_WEIGHTS = {COMPLEMENTARY: 1.35, COORDINATED: 1.20, CROSS_SELL: 1.00, FAMILY: 0.75}
ACTIONS = {
    COMPLEMENTARY: "Accessory / Complementary Recommendation",
    COORDINATED: "Bundle / Set Recommendation",
}
DEFAULT_ACTION = "Cross-Sell Recommendation"
ADVICE = {
    COMPLEMENTARY: "Use as a targeted accessory recommendation or checkout cross-sell.",
    COORDINATED: "Evaluate bundled merchandising, coordinated product placement, or multi-item offers.",
}
DEFAULT_ADVICE = "Use as a personalized recommendation based on basket composition."

# Customer segments used by name.
AT_RISK_HIGH_VALUE = "At Risk High Value"
HIGH_RETURN_TIERS = ["High Return Risk", "Very High Return Risk"]
HIGH_VALUE_HIGH_RISK = "High Value / High Return Risk"
VALUE_TIERS = ["Low Value", "Mid Value", "High Value", "Very High Value"]

# Product states used by name.
VALIDATED = "Validated Commercial Product"
COMMERCIAL_DESCRIPTION = "Commercial Description"
TIER_1 = "Tier 1 - Strategic"
TIER_2 = "Tier 2 - High Value"
TIER_3 = "Tier 3 - Established"
TIER_4 = "Tier 4 - Long Tail"
NOT_APPLICABLE = "Not Applicable"

# Top shares reported by the concentration results, in percent.
TOP_PERCENTS = [1, 5, 10, 20]
