"""Spool files as input and output."""
