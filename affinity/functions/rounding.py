"""Rounding of scores to a fixed number of decimals.

round_half_away(x, 5) = sign(x) * floor(|x| * 1e5 + 0.5) / 1e5, pure double
arithmetic (stays in generated code; Spark's ``round`` goes through a
BigDecimal per row).  It is the rule SQL engines apply to doubles and the
one the numpy block kernels use, so every path rounds identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, places: int = 5) -> Column:
    m = float(10 ** places)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(m) + F.lit(0.5)) / F.lit(m)
