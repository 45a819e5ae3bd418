"""DuckDB SQL for the named results, built from named subqueries.

Written on its own: plain windows, direct distinct counts and joins of the
transaction lines, where the Spark jobs roll up in steps and rank by ranges.
"""

from __future__ import annotations

import re

from oracle.results import RESULTS
from oracle.tables import TABLES


def _needed(text: str, found: list[str]) -> None:
    """Names of the subqueries that `text` uses, in dependency order."""
    for name in TABLES:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(TABLES[name], found)
            found.append(name)


def query(text: str) -> str:
    """`text` with the subqueries it needs in front."""
    names: list[str] = []
    _needed(text, names)
    if not names:
        return text
    parts = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name].strip()})" for name in names)
    return f"WITH {parts}\n{text.strip()}"


def _unnumbered(sql: str) -> str:
    """`sql` over raw lines of which every 13th customer has no invoice numbers."""
    start = "x_raw AS MATERIALIZED ("
    blanked = 'SELECT * REPLACE (CASE WHEN "Customer ID" % 13 = 0 THEN NULL ELSE Invoice END AS Invoice) FROM x_numbered'
    body = TABLES["x_raw"].strip()
    return sql.replace(f"{start}{body})", f"x_numbered AS MATERIALIZED ({body}),\n{start}{blanked})")


def all_queries() -> dict[str, str]:
    """SQL per named result."""
    found = {name: query(text) for name, text in RESULTS.items()}
    return {name: _unnumbered(sql) if name.endswith("_unnumbered") else sql for name, sql in found.items()}
