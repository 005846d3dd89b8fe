"""Planning parameters as frozen dataclasses.

The defaults are the settings of the planning application we mirror; they
are fixed values that results are compared against.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: default planning settings --------------------------------
DEFAULT_HOLDING_COST = 0.05          # per unit per week
DEFAULT_ORDERING_COST = 5000.0       # per order
DEFAULT_SAFETY_WEEKS = 1
DEFAULT_MAX_ORDER = 100_000_000.0
DEFAULT_NUM_VEHICLES = 5
DEFAULT_VEHICLE_CAPACITY = 50_000_000.0
DEFAULT_DEPOTS = (
    (0, "Central Depot", 39.8283, -98.5795),
    (1, "East Depot", 35.2271, -80.8431),
    (2, "West Depot", 34.0522, -118.2437),
)
DEFAULT_MAX_DISTANCE_KM = 5000.0     # present in the settings, never used
DEFAULT_N_ESTIMATORS = 50
DEFAULT_MAX_DEPTH = 4
DEFAULT_LEARNING_RATE = 0.1
DEFAULT_TEST_WEEKS = 13
DEFAULT_LAGS = (1, 2, 4, 8, 12)
DEFAULT_HORIZON = 13
DEFAULT_SPIKE_FACTOR = 1.2
DEFAULT_DELAY_DAYS = 7
DEFAULT_FAILED_DEPOT = 0
RUSH_ORDER_PENALTY = 1.1
FUEL_COST_PER_KM = 1.5
MIN_UPLOAD_ROWS = 100
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class InventoryParams:
    holding_cost: float = DEFAULT_HOLDING_COST
    ordering_cost: float = DEFAULT_ORDERING_COST
    safety_weeks: float = DEFAULT_SAFETY_WEEKS
    max_order: float = DEFAULT_MAX_ORDER
    initial_factor: float = 1.5      # initial stock = 1.5 x safety stock
    min_periods: int = 2             # series shorter than this are skipped


@dataclass(frozen=True)
class RoutingParams:
    num_vehicles: int = DEFAULT_NUM_VEHICLES
    capacity: float = DEFAULT_VEHICLE_CAPACITY
    depots: tuple = DEFAULT_DEPOTS
    default_demand: float = 5000.0
    # groups (plan, depot) with more stops than this are routed by leases of at
    # most so many stops around each vehicle, instead of in one Python task
    local_group_limit: int = 50_000
    lease: int = 20_000


@dataclass(frozen=True)
class ForecastParams:
    n_estimators: int = DEFAULT_N_ESTIMATORS
    max_depth: int = DEFAULT_MAX_DEPTH
    learning_rate: float = DEFAULT_LEARNING_RATE
    subsample: float = 0.8
    min_leaf: int = 5
    # a node of fewer rows is not split; follows from min_leaf up to twice its size
    min_split: int = 10
    seed: int = 42
    test_weeks: int = DEFAULT_TEST_WEEKS
    lags: tuple = DEFAULT_LAGS
    horizon: int = DEFAULT_HORIZON
    min_history: int = 13
    # train-time std is the sample std; the serving path of the application
    # uses the population std of the last 4 values
    serve_std_population: bool = True
    with_markdowns: bool = True


@dataclass(frozen=True)
class ScenarioParams:
    spike_factor: float = DEFAULT_SPIKE_FACTOR
    delay_days: int = DEFAULT_DELAY_DAYS
    failed_depot: int = DEFAULT_FAILED_DEPOT
    rush_penalty: float = RUSH_ORDER_PENALTY
    fuel_cost_per_km: float = FUEL_COST_PER_KM


@dataclass(frozen=True)
class PlanningParams:
    inventory: InventoryParams = field(default_factory=InventoryParams)
    routing: RoutingParams = field(default_factory=RoutingParams)
    forecast: ForecastParams = field(default_factory=ForecastParams)
    scenario: ScenarioParams = field(default_factory=ScenarioParams)
