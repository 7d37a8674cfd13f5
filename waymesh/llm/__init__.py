"""Operations of a training-data pipeline. Nothing else in the library imports this."""

from waymesh.llm.queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
