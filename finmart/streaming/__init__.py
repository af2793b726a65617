"""Incremental and streaming maintenance of the model (the documented
scale-up path): fact kept from landed batches, high-water-mark and
Structured Streaming ingestion, report refresh on a trigger, freshness."""

from finmart.streaming.incremental import (LandedSales, hwm_ingest,
                                           source_freshness)
from finmart.streaming.stream import refresh_on_new_lines, stream_ingest

__all__ = ["hwm_ingest", "LandedSales", "source_freshness", "stream_ingest",
           "refresh_on_new_lines"]
