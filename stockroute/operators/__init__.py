"""DataFrame operators: validation, features, aggregates, forecasting,
inventory planning, routing and what-if scenarios."""
