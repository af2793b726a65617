"""Relational operators the model needs beyond single DataFrame calls."""

from finmart.operators.scd2 import scd2_snapshot, SCD_COLUMNS
from finmart.operators.asof import asof_left_join
from finmart.operators.ranking import with_global_position, global_ntile, global_rank
from finmart.operators import checks

__all__ = ["scd2_snapshot", "SCD_COLUMNS", "asof_left_join", "with_global_position",
           "global_ntile", "global_rank", "checks"]
