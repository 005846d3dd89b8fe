"""Training-data operators: search, scans, filters, dedup, packing, scoring.

Nothing outside this package imports it.  ``queries.QUERIES`` holds the
registered queries, ``queries.ORACLES`` their DuckDB statements.
"""
