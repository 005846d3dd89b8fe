"""Column-level functions (JVM expressions, no Python UDFs)."""

from stockroute.functions.columns import *  # noqa: F401,F403
