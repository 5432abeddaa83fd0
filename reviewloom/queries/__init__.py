"""Registered queries over the test tables, each with the SQL that gives the same result."""

from reviewloom.queries import files, partitions, runs, sampling, scoring, statistics, text

_MODULES = (text, sampling, scoring, statistics, partitions, runs, files)


def all_queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
