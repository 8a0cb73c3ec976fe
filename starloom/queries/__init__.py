"""Every operator as a query on the test tables, with an SQL twin where one exists."""

from starloom.queries import (  # noqa: F401
    checks, groups, joins, layouts, loads, reports, rows, scalars, scans, stars,
)
from starloom.queries.registry import ORACLES, QUERIES  # noqa: F401
