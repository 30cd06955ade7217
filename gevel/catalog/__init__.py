"""Queries over the test tables, each with the SQL that gives the same rows."""

from gevel.catalog import documents, spatial, tables, tiles

MODULES = (spatial, tiles, tables, documents)


def all_queries() -> dict:
    return {name: fn for m in MODULES for name, (fn, _) in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql is not None}
