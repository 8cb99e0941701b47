"""Whole queries: star-schema reports and SQL scripts."""
