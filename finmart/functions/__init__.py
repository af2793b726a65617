"""Column-level helpers: all return ``Column`` expressions built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from finmart.functions.keys import surrogate_key, date_key, year_month_key, scd_version_id
from finmart.functions.decimals import (
    MONEY, QTY, RATE, INTERMEDIATE, COST, RATIO, INDEX, SUM_MONEY,
    dec, money_round_two_step, guarded_ratio, share,
)
from finmart.functions.metadata import with_ingestion_metadata
from finmart.functions.dates import (
    day_of_week_sunday0, is_weekday, month_short_name, month_long_name,
    day_short_name, day_long_name, year_quarter_key,
)

__all__ = [
    "surrogate_key", "date_key", "year_month_key", "scd_version_id",
    "MONEY", "QTY", "RATE", "INTERMEDIATE", "COST", "RATIO", "INDEX", "SUM_MONEY",
    "dec", "money_round_two_step", "guarded_ratio", "share",
    "with_ingestion_metadata",
    "day_of_week_sunday0", "is_weekday", "month_short_name", "month_long_name",
    "day_short_name", "day_long_name", "year_quarter_key",
]
