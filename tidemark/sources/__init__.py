"""Readers of the feeds' formats: each gives a DataFrame."""
