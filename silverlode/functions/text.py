"""Text standardisation.  NULL stays NULL; only spaces are trimmed."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def upper_clean(name: str) -> Column:
    return F.upper(trimmed(name))


def lower_clean(name: str) -> Column:
    return F.lower(trimmed(name))
