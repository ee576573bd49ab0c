"""Whole jobs: cleaning raw tables, the star schema, the reports."""
