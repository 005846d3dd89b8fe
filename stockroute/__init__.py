"""stockroute: demand planning and delivery analytics on Spark DataFrames.

Every operator takes DataFrames (and plain parameters) and returns lazy
DataFrames.  Work is expressed with the DataFrame API so that Catalyst can
prune columns, push filters into the Parquet scan and plan the shuffles; the
only Python inside tasks is the per-depot tour builder in
``operators.routing`` (NumPy over one bounded group).
"""

from stockroute.config import (  # noqa: F401
    ForecastParams,
    InventoryParams,
    RoutingParams,
    ScenarioParams,
    PlanningParams,
)

__all__ = [
    "ForecastParams",
    "InventoryParams",
    "RoutingParams",
    "ScenarioParams",
    "PlanningParams",
]
