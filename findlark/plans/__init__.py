"""Queries, results, stored index versions and the jobs composed from them."""
