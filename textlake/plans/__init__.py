"""The registry: every operator as a query over the given tables.

Each module has ``QUERIES`` (name to a function of session and table folder) and
``ORACLES`` (name to the same query as DuckDB SQL, where SQL can express it).
"""

from __future__ import annotations

from textlake.plans import chat, documents, files, news, people, retrieval, sales

MODULES = (people, sales, files, news, documents, retrieval, chat)


def queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
