"""Bronze: each source table landed as-is plus load metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finmart.functions.metadata import DEFAULT_SOURCE_SYSTEM, with_ingestion_metadata
from finmart.sources.schemas import SOURCE_TABLES

BRONZE_NAMES = {t: f"tpch_{t}" for t in SOURCE_TABLES}


def bronze(source: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM,
           batch_id: str = "manual", ingested_at: str | None = None) -> DataFrame:
    """Source columns in landing order, then _ingested_at, _source_system, _batch_id."""
    return with_ingestion_metadata(source, source_system, batch_id, ingested_at)
