"""Readers and writers for panels, importances, trials, scores and reports."""
