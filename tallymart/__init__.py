"""tallymart: service-episode KPIs and published-indicator analytics as PySpark jobs."""

from tallymart.params import GeographyCodes, Params, Period
from tallymart.session import build_session

__all__ = ["GeographyCodes", "Params", "Period", "build_session"]
