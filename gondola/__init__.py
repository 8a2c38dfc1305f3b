"""Catalogue extraction on Spark: stored web pages in, a clean product table out."""
