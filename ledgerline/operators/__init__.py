"""Relational operators built from Spark joins, groupings and windows."""
