"""Deterministic keys.

Surrogate keys are md5 hex strings of the '-'-joined text of their parts,
with NULL parts replaced by a sentinel so that (NULL, 1) and (1, NULL) hash
differently and no part can vanish.  Date keys are integers built
arithmetically (year*10000 + month*100 + day), which keeps them in codegen and
avoids format-string parsing per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text a NULL key part is replaced by, and the separator
# between parts.  Changing either changes every surrogate key.
NULL_PART = "__null__"
PART_SEPARATOR = "-"
# Separator inside a snapshot version id: md5(<key> | <as_of>).
SCD_ID_SEPARATOR = "|"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 of the null-safe, order-sensitive text of ``cols``."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PART)) for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat_ws(PART_SEPARATOR, *parts)
    return F.md5(text)


def scd_version_id(key, as_of_text: Column) -> Column:
    """Version id of a snapshot row: md5(key | as_of as text)."""
    return F.md5(F.concat(_col(key).cast("string"), F.lit(SCD_ID_SEPARATOR), as_of_text))


def date_key(d) -> Column:
    """YYYYMMDD as int; NULL date → NULL key."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month_key(d) -> Column:
    """YYYYMM as int."""
    d = _col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")
