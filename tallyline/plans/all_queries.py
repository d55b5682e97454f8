"""Importing this module registers every query."""

from tallyline.plans import alert_queries, asset_queries, cost_queries, job_queries, mart_queries, state_queries  # noqa: F401
