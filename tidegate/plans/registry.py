"""All registered queries."""

from __future__ import annotations

from functools import wraps

from tidegate.plans import file_queries, load_queries, profile_queries
from tidegate.session import tune

FLAGSHIP = "load_good_rows"
_MODULES = (file_queries, load_queries, profile_queries)


def tuned(query):
    @wraps(query)
    def run(spark, sf_dir):
        return query(tune(spark), sf_dir)

    return run


def queries() -> dict:
    return {name: tuned(query) for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
