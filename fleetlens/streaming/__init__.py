"""Incremental refresh of run metrics from a growing event-log directory."""
