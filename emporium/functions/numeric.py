"""Safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b as double; null when b is 0 or null (a blank, not an error or infinity)."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))
