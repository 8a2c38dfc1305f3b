"""Inputs and outputs: saved pages, page corpora, sitemaps, robots files, result tables."""
