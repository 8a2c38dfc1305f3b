"""Whole runs, from stored pages to tables."""
