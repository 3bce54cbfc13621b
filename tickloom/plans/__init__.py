"""Whole jobs: read stored tables, run operators, write results."""
