"""Queries over the given tables, one per operator, each with the SQL that must agree."""

from driver_checks import domain, merging, privacy, quality, relational, sources  # noqa: F401
from driver_checks.base import ORACLES, QUERIES  # noqa: F401
