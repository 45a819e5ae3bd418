"""Thresholds of the pipeline. The defaults are the business values."""

from __future__ import annotations

from dataclasses import dataclass, field

from ledgerlark import constants as C


@dataclass(frozen=True)
class Vocabulary:
    """Terms that decide the type of a product association."""

    complementary: tuple = tuple(C.COMPLEMENTARY_TERMS)
    coordinated: tuple = tuple(C.COORDINATED_TERMS)
    family: tuple = tuple(C.FAMILY_TERMS)


@dataclass(frozen=True)
class Settings:
    """Currency amounts, counts and vocabulary that a data set may override."""

    high_value_customer: int = 10000
    opportunity_value: int = 3000
    product_tiers: tuple = (100000, 25000, 5000)
    basket_item: str = "StockCode"
    min_pair_orders: int = 20
    heavy_basket: int = 2000
    cross_sell_orders: int = 50
    cross_sell_lift: float = 10.0
    cross_sell_confidence: float = 0.60
    cross_sell_top: int = 50
    vocabulary: Vocabulary = field(default_factory=Vocabulary)
