"""Example workload: pages rendered from the ``part`` table, queries over them, and check SQL."""
