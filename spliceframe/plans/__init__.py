"""The registered queries: operators over the carriers, and SQL that gives the same rows."""

from spliceframe.plans import q_effects, q_embedding, q_sources, q_tables, q_usage  # noqa: F401
from spliceframe.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
