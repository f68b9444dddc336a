"""Whole jobs: the medallion run, the warehouse tables and views, scoring, monitoring, training."""
