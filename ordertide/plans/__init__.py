"""Whole pipelines: from input tables to a report, and the jobs that run them."""
