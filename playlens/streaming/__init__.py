"""Continuous variant of the daily staging load."""
