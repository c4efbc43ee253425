"""All queries of the raster engine by name, and the SQL that says the same."""

from .queries import archives, blocks, chunks, colour, focal, geodesy, mosaics, planning, records, renders, tiling  # noqa: F401
from .queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
