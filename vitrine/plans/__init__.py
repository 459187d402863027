"""Analyses as DataFrame plans, their registry, and the DuckDB oracle."""
