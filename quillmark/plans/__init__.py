"""Registered queries of the analytics and their oracles, gathered from the modules of this package."""

from quillmark.plans import analytics, history, jobs, market, saved_pages, streams, tables

_MODULES = (analytics, history, jobs, market, saved_pages, streams, tables)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
