"""Panels built from the base tables, the query catalogue and whole studies."""
