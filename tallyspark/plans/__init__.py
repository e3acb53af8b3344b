"""Whole jobs: read tables, run the operators, check, write tables."""
