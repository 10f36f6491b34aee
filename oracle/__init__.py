"""DuckDB texts that state, independently of the Spark jobs, what each query must return."""

from .texts import oracle_sql

__all__ = ["oracle_sql"]
