"""Exact money arithmetic.

Amounts are DOUBLE in the tables, decimal inside every sum, product and rounding, and DOUBLE
again in the result: decimal sums do not depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(18,6)"


def exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(EXACT)


def cents(amount: Column) -> Column:
    return F.round(amount, 2)
