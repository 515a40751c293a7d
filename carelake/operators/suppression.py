"""Statistical secrecy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MINIMUM_CELL = 5


def suppress_small_cells(cells: DataFrame, count_column: str, minimum: int = MINIMUM_CELL) -> DataFrame:
    """Drop the cells that describe fewer than `minimum` people."""
    return cells.filter(F.col(count_column) >= minimum)
