"""Registered queries: each operator over the given tables, with its SQL twin."""

from chronolode.queries import arrays, catalogue, files, joins, names, ranges, spatial, stats, streams, timeaxis, typed, values

MODULES = (files, names, spatial, timeaxis, ranges, joins, stats, arrays, values, typed, catalogue, streams)


def all_queries() -> dict:
    return {name: run for module in MODULES for name, (run, _) in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
