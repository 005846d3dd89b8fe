"""Composed plans: reports, the full planning run and the query catalog."""
