"""The operators applied to the star tables, by name."""

from formline.plans.star import checks, events, form, gates, learned, loads, matches, ranks, schedules, selection, served, shapes, streams  # noqa: F401
from formline.plans.star.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
