"""The registered queries of the engine's own operators and their SQL twins."""

from tidemark.plans import activity, aggregates, audit, delta, entities, extract, facts, policies, relations, resolution, rules, scalars, sources, taxonomy, victims  # noqa: F401
from tidemark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
