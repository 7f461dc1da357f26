"""Queries over the driver tables, one per operator, with SQL equivalents."""

from fragloom.catalog.registry import ORACLE, QUERIES


def load():
    from fragloom.catalog import (  # noqa: F401
        cohort_queries, coverage_queries, fragment_queries, matrix_queries, model_queries,
        sample_queries, score_queries, source_queries,
    )
    return QUERIES, ORACLE
