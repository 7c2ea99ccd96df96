"""Whole jobs: ingest one search, build a catalog."""
