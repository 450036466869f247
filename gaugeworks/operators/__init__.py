"""Operators on DataFrames: joins, indexes, timelines, ownership, reconciliation, reports."""
