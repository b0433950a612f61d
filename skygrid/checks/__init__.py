"""Every operator as a query over the shared test tables, with its SQL twin."""

from skygrid.checks.registry import QUERIES, SQL
from skygrid.checks import geometry, layout, scalars, stations, weather  # noqa: F401

__all__ = ["QUERIES", "SQL"]
