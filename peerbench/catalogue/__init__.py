"""Queries over the test tables, with their SQL twins."""

from peerbench.catalogue import grids, lookups, reports, resolution, statistics  # noqa: F401
from peerbench.catalogue.registry import ORACLES, QUERIES  # noqa: F401
