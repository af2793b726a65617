"""Sources (the eight landed tables) and sinks (layered tables, snapshots,
check failures)."""

from finmart.sources.schemas import SOURCE_COLUMNS, SOURCE_TABLES, source_schema
from finmart.sources.reader import read_source, partsupp_standin, Sources
from finmart.sources.history import customer_extracts, HISTORY_RUNS

__all__ = ["SOURCE_COLUMNS", "SOURCE_TABLES", "source_schema", "read_source",
           "partsupp_standin", "Sources", "customer_extracts", "HISTORY_RUNS"]
