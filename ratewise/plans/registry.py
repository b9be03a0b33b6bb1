"""All registered queries."""

from ratewise.plans import evaluation_queries, explore_queries, model_queries, text_queries, wide_queries, workflow_queries

_MODULES = (explore_queries, text_queries, evaluation_queries, model_queries, workflow_queries, wide_queries)


def queries():
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
