"""The airline configuration of the operators: cleaning to star schema, and its dashboard."""

from .airline import Airline, run
from .dashboard import Dashboard

__all__ = ["Airline", "Dashboard", "run"]
