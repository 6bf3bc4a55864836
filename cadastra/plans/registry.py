"""All queries of the engine by name, with the SQL that must give the same rows."""

from __future__ import annotations

from cadastra.plans import claims, edits, relational, spatial, text, windows

MODULES = (claims, relational, windows, spatial, text, edits)

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}
