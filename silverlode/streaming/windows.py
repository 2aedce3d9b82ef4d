"""Window totals over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions.money import exact_sum

# Window length and how long late rows are waited for.
WINDOW, LATENESS = "1 minute", "10 minutes"


def window_totals(
    events: DataFrame, window: str = WINDOW, lateness: str = LATENESS,
    event_time: str = "transaction_timestamp",
) -> DataFrame:
    """Count and revenue per tumbling window and status.

    Works on a stream and on a batch.  Only two totals per open (window, status)
    are kept as state, and the watermark lets go of closed windows.  Revenue in whole
    cents is the same whatever order rows arrive in.
    """
    return (
        events.withWatermark(event_time, lateness)
        .groupBy(F.window(event_time, window), "status")
        .agg(F.count("transaction_id").alias("transaction_count"),
             exact_sum("final_amount").alias("total_revenue"))
    )
