"""Whole jobs: from spool files to tables."""
