"""Whole jobs: lake layout, refreshes, dashboard queries and the query catalogue."""
