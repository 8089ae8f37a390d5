"""Ranges of numbers as cells of a grid: what lies in a range is looked up by equal keys, without comparing rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = 16


def grid_cell(value: Column, width: float) -> Column:
    """Number of the grid cell; ``width`` has 2**LEVELS of them. It never falls where the value grows."""
    return F.floor(value / F.lit(width / (1 << LEVELS)))
