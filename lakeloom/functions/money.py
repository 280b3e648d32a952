"""Money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_to_dollars(cents: Column | str, precision: int = 2) -> Column:
    """Whole or fractional cents as ``decimal(16, precision)`` dollars, exact before rounding."""
    column = F.col(cents) if isinstance(cents, str) else cents
    return (column.cast("decimal(18,2)") / F.lit(100)).cast(f"decimal(16,{precision})")
