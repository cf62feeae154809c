"""Runnable queries: every operator applied to whole tables, with SQL twins."""

from keelson.plans.registry import QUERIES, Query, load_all

__all__ = ["QUERIES", "Query", "load_all"]
