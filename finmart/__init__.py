"""finmart — customer profitability and margin analytics on Spark.

Every public function takes and returns DataFrames; nothing is collected
to the driver except single scalars (a window anchor, a row count used to
pick a plan).  See README.md for the layer map.
"""

from finmart.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
