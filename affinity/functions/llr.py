"""Log-likelihood ratio of a 2x2 contingency table (Dunning 1993).

For a pair (x, y) among N users: k11 users have both, ``a`` have x, ``b``
have y.  The four cells are k11, k12 = a-k11, k21 = b-k11, k22 = N-a-b+k11
with row sums (a, N-a) and column sums (b, N-b).  The statistic is written
in its ratio form

    LLR = 2 * sum over cells of k * ln(k * N / (row * col))   (0 when k = 0)

which equals the entropy form  2 (H(rows) + H(cols) - H(matrix))  but does
not cancel large terms against each other as N grows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _term(k: Column, row: Column, col: Column, n: Column) -> Column:
    # k <= row and k <= col, so row * col > 0 whenever the branch is taken.
    return F.when(k > 0, k * F.log(k * n / (row * col))).otherwise(F.lit(0.0))


def llr(k11: Column, a: Column, b: Column, n: Column) -> Column:
    """LLR as a double Column; inputs are counts (any integral type)."""
    k11, a, b, n = (c.cast("double") for c in (k11, a, b, n))
    k12 = a - k11
    k21 = b - k11
    k22 = n - a - b + k11
    s = (_term(k11, a, b, n) + _term(k12, a, n - b, n)
         + _term(k21, n - a, b, n) + _term(k22, n - a, n - b, n))
    return F.greatest(F.lit(0.0), F.lit(2.0) * s)


def independent(k11: Column, a: Column, b: Column, n: Column) -> Column:
    """True when the table is exactly independent (LLR = 0): k11 * N = a * b.

    Decided in exact integer arithmetic, never by comparing a float with 0.
    """
    dec = "decimal(19,0)"
    return (k11.cast(dec) * n.cast(dec)) == (a.cast(dec) * b.cast(dec))
