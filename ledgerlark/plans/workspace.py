"""Stage tables of one landing set, each built once per session on first use.

    raw -> repeated_lines -> clean -> clean_measures
    clean -> orders -> customers -> rfm -> value -> risk
          |         |           `-> customers_by_all_lines, customers_by_net (sorted and numbered)
          |         `-> cohorts
          |-> product_months
          |-> names, product_orders -> products -> taxonomy, intelligence
          |                         |           |-> merchandise_by_gross (sorted and numbered)
          |                         |           `-> quality -> master -> scope -> anomalies
          `-> members (clean or product_orders, taxonomy) -> basket -> associations -> scored -> cross_sell
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation

from ledgerlark.operators.cleaning import clean_transactions
from ledgerlark.operators.picks import first_names, modal_names
from ledgerlark.operators.rollup import (
    customer_facts, name_facts, order_facts, product_facts, product_months, product_orders, product_sums,
)
from ledgerlark.operators.profile import repeated_hashes
from ledgerlark.plans import audits, baskets, catalogue, cohorts, customers, dashboard, kpis, products, rfm
from ledgerlark.settings import Settings
from ledgerlark.storage import read_kept, small_tasks, write_kept, write_stage


class Workspace:
    """Lazily built stage tables over raw invoice lines.

    With a `folder`, stage tables are kept there under their names, and
    `resume=True` reads those that an earlier run has finished from the same
    `source` (what names the raw lines) and settings. Without a folder they go
    to the shared folder of the session.
    """

    def __init__(
        self, raw: DataFrame, settings: Settings = Settings(), folder: str | None = None, resume: bool = False,
        source: str = "",
    ):
        self.raw = raw
        self.settings = settings
        self.folder = folder
        self.resume = resume
        self.origin = f"{source} {settings} {raw.schema.simpleString()}"
        self._tables: dict[str, DataFrame] = {}
        self._seen: dict[str, Observation] = {}
        self._sheets: list[str] | None = None

    def stage(self, name: str) -> DataFrame:
        """Stage table `name`, written on first use."""
        if name not in self._tables:
            with small_tasks(self.raw.sparkSession):
                self._tables[name] = self._build(name)
        return self._tables[name]

    def _build(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if self.folder is not None and self.resume:
            kept = read_kept(self.raw.sparkSession, path, self.origin)
            if kept is not None:
                return kept
        df = STAGES[name](self)
        if name in OBSERVED:
            self._seen[name] = Observation(name)
            df = df.observe(self._seen[name], *OBSERVED[name]())
        return write_stage(df, name) if self.folder is None else write_kept(df, path, self.origin)

    def observed(self, name: str) -> DataFrame:
        """What was observed of a stage table while it was written, as one row.

        A table that an earlier run has written is scanned instead.
        """
        table, measures = self.stage(name), OBSERVED[name]()
        if name not in self._seen:
            return table.agg(*measures)
        found = self._seen[name].get
        schema = table.agg(*measures).schema
        return table.sparkSession.createDataFrame([tuple(found[c] for c in schema.names)], schema)

    @property
    def sheets(self) -> list[str]:
        """Names of the yearly sheets."""
        if self._sheets is None:
            self._sheets = [row.SourceYear for row in self.raw.select("SourceYear").distinct().collect()]
        return self._sheets

    def __getattr__(self, name: str) -> DataFrame:
        if name in STAGES:
            return self.stage(name)
        raise AttributeError(name)

    def basket_members(self) -> DataFrame:
        """Items of all merchandise orders, for the item of the settings."""
        item = self.settings.basket_item
        if item == "StockCode":
            return baskets.basket_members(self.product_orders, self.taxonomy)
        return baskets.described_members(self.clean, self.taxonomy, item)

    def dashboard(self, role: str) -> DataFrame:
        """Serving table of a role."""
        return dashboard.ROLES[role](self)


STAGES: dict[str, Callable[[Workspace], DataFrame]] = {
    "repeated_lines": lambda w: repeated_hashes(w.raw),
    "clean": lambda w: clean_transactions(w.raw, w.repeated_lines),
    "clean_measures": lambda w: w.observed("clean"),
    "orders": lambda w: order_facts(w.clean),
    "customers": lambda w: customer_facts(w.orders),
    "customers_by_all_lines": lambda w: kpis.by_all_lines(w.customers),
    "customers_by_net": lambda w: customers.by_net(w.customers),
    "product_months": lambda w: product_months(w.clean),
    "product_orders": lambda w: product_orders(w.clean),
    "products": lambda w: product_facts(product_sums(w.clean), w.product_orders),
    "names": lambda w: name_facts(w.clean),
    "sale_names": lambda w: modal_names(w.names),
    "first_names": lambda w: first_names(w.names, w.clean),
    "rfm": lambda w: rfm.customer_rfm(w.customers),
    "value": lambda w: rfm.customer_value(w.customers, w.rfm),
    "risk": lambda w: rfm.customer_risk(w.value),
    "cohorts": lambda w: cohorts.cohort_retention(w.orders),
    "intelligence": lambda w: products.product_intelligence(w.products, w.sale_names),
    "taxonomy": lambda w: products.product_taxonomy(w.products, w.sale_names),
    "merchandise_by_gross": lambda w: products.merchandise_by_gross(w.products, w.taxonomy),
    "quality": lambda w: catalogue.product_quality(w.products, w.first_names),
    "master": lambda w: catalogue.product_master(w.quality, w.settings.product_tiers),
    "scope": lambda w: catalogue.product_scope(w.master, w.settings.product_tiers),
    "anomalies": lambda w: catalogue.product_anomalies(w.scope),
    "members": lambda w: w.basket_members(),
    "basket": lambda w: baskets.basket_scope(w.members),
    "associations": lambda w: baskets.product_associations(
        w.basket, w.taxonomy, w.settings.basket_item, w.settings.min_pair_orders, w.settings.heavy_basket
    ),
    "scored": lambda w: baskets.scored_opportunities(
        w.associations, w.settings.cross_sell_orders, w.settings.cross_sell_lift, w.settings.cross_sell_confidence,
        w.settings.vocabulary,
    ),
    "cross_sell": lambda w: baskets.cross_sell(w.scored, w.settings.cross_sell_top),
}


#: What is observed of a stage table while it is written.
OBSERVED: dict[str, Callable[[], list[Column]]] = {"clean": audits.clean_measures}
