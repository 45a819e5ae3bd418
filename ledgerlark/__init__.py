"""Ledgerlark: retail commerce analytics as Spark jobs."""

from ledgerlark.plans.workspace import STAGES, Workspace
from ledgerlark.settings import Settings, Vocabulary
from ledgerlark.sources.landing import load_bundle, load_raw, read_table, register_view, write_bundle, write_table

__all__ = [
    "STAGES", "Settings", "Vocabulary", "Workspace", "load_bundle", "load_raw", "read_table", "register_view",
    "write_bundle", "write_table",
]
