"""Named queries over the driver's tables, and the DuckDB SQL that each is held against."""

from __future__ import annotations

from terrace.plans import atomic, contract, mapped, normalised, places, rasters, roads, things, trials

_ALL = {k: v for plan in (places, rasters, roads, things, normalised, trials, contract, atomic, mapped) for k, v in plan.QUERIES.items()}

QUERIES: dict = {k: query for k, (query, _) in _ALL.items()}
#: Queries without SQL are tested against brute force.
ORACLE_SQL: dict = {k: sql for k, (_, sql) in _ALL.items() if sql}
