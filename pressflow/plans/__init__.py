"""Whole jobs composed from operators: pipelines, dashboards and the query catalogue."""
