"""Registered queries over the supplied tables, each next to its SQL check."""

from wayfold.plans import analytics_queries, draw_queries, match_queries, model_queries, route_queries, stream_queries  # noqa: F401
from wayfold.plans.registry import CHECKS, QUERIES  # noqa: F401
