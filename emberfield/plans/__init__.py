"""Named queries that bind the operators to tables."""

from __future__ import annotations


def catalogue():
    """All registered queries by name."""
    from emberfield.plans import cleaning_queries, fire_queries, grid_queries, job_queries, join_queries  # noqa: F401
    from emberfield.plans import loading_queries, model_queries, narrative_queries, quality_queries  # noqa: F401
    from emberfield.plans.registry import CATALOGUE

    return CATALOGUE
