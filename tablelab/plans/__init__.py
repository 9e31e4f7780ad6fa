"""Fixture views over the given tables, and the registered queries built on them."""
