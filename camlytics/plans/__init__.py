"""The registered queries and the SQL that checks them."""

from camlytics.plans import moving, objects, parsing, statistics, storage, streams

MODULES = (parsing, statistics, objects, storage, streams, moving)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.ORACLE.items()}
