"""Operators on DataFrames: dedup, merges, classification, increments, retries, rollups, event log, resolution, archive and checks."""
