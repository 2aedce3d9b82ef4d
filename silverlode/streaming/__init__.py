from silverlode.streaming.events import decode_events, enrich_events
from silverlode.streaming.jobs import gold_stream, ingest_stream, silver_stream, totals_table, windowed_stream
from silverlode.streaming.windows import window_totals

__all__ = ["decode_events", "enrich_events", "gold_stream", "ingest_stream", "silver_stream",
           "totals_table", "window_totals", "windowed_stream"]
