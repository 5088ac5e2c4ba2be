"""Whole jobs: registry, loads and runs."""
