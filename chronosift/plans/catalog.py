"""Registered queries of the engine and their DuckDB counterparts."""

from __future__ import annotations

from chronosift.plans import queries_data, queries_flow, queries_series, queries_signals

_PARTS = (queries_signals.Q, queries_series.Q, queries_data.Q, queries_flow.Q)
QUERIES: dict = {name: fn for part in _PARTS for name, fn in part.queries.items()}
ORACLES: dict = {name: sql for part in _PARTS for name, sql in part.oracles.items()}
