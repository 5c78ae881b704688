"""Every operator as a query over the given tables, with equal SQL beside it."""

from tierline.queries import cleaning, edges, landing, loads, quality, runlog, silver  # noqa: F401
from tierline.queries.registry import ORACLES, QUERIES  # noqa: F401
