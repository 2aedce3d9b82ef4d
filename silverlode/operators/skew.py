"""Spreading equal rows over tasks.

Joins are left to adaptive execution, which splits a skewed partition at run
time.  It cannot split a window partition, so windows rank in lanes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread_lane() -> Column:
    """A deterministic way to spread equal rows over many tasks.

    The number of the input partition depends neither on the row nor on the order
    of rows, so a retried task sends every row where the first attempt did --
    which a random salt would not -- and exact copies still part ways.
    """
    return F.spark_partition_id()
