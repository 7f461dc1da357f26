"""Registry of queries over the driver tables and their SQL equivalents."""

from pyspark.sql import DataFrame, functions as F

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its DuckDB text where there is one."""
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function
    return add


def rounded(df: DataFrame, *columns, digits: int = 9) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
