"""Load metadata stamped on every landed (bronze) row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: default source-system label of the landed tables.
DEFAULT_SOURCE_SYSTEM = "TPCH_SF1"
META_COLUMNS = ("_ingested_at", "_source_system", "_batch_id")


def with_ingestion_metadata(df: DataFrame, source_system: str = DEFAULT_SOURCE_SYSTEM,
                            batch_id: str = "manual", ingested_at: str | None = None) -> DataFrame:
    """Append _ingested_at (timestamp_ntz), _source_system, _batch_id.

    ``ingested_at`` pins the load time (reproducible runs and tests); by
    default the session's current local timestamp is used — one value per
    query, identical on every row.
    """
    ts = (F.lit(ingested_at).cast("timestamp_ntz") if ingested_at is not None
          else F.localtimestamp())
    return df.withColumns({
        "_ingested_at": ts,
        "_source_system": F.lit(source_system),
        "_batch_id": F.lit(batch_id),
    })
